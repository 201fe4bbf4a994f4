"""Entities: tagging, span decoding, indexes and reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import identifiers as ids
from corpuslens.functions import text as tx
from corpuslens.session import cut_lineage

ENTITY_COLUMNS = {"method": "methods", "dataset": "datasets", "task": "tasks"}
PREDICTIONS = "paper_id string, pos int, token string, label string, score double, start int, end int"


def prioritise_sections(
    sections: Column, full_text: Column, k: int = 5, fallback_chars: int | None = None,
    headings: Sequence[str] = fixed.PRIORITY_HEADINGS,
) -> Column:
    """Bodies of the first `k` sections, those with a telling heading first.

    Without sections the full text is taken, whole unless `fallback_chars` limits it.
    """

    def telling(s: Column) -> Column:
        return tx.contains_any(F.lower(F.coalesce(s["heading"], F.lit(""))), headings)

    ordered = F.concat(F.filter(sections, telling), F.filter(sections, lambda s: ~telling(s)))
    bodies = F.transform(F.slice(ordered, 1, k), lambda s: s["text"])
    joined = F.array_join(F.filter(bodies, lambda t: F.coalesce(t, F.lit("")) != ""), " ")
    fallback = full_text if fallback_chars is None else F.substring(full_text, 1, fallback_chars)
    return F.when(F.size(F.coalesce(sections, F.array())) > 0, joined).otherwise(ids.non_empty(fallback))


def prepare_for_tagging(papers: DataFrame, text: str = "abstract", least: int = 50) -> DataFrame:
    """Clean, sentence-joined texts that are long enough."""
    cleaned = tx.clean_text(papers, text, "_clean")
    # A filter on the clean text would be moved below it and clean every text twice.
    kept = F.filter(F.array(tx.rejoin_sentences(F.col("_clean"))), lambda t: F.length(t) >= least)
    return tx.unfold(cleaned, kept, "text", "paper_id")


def _slices(texts: Sequence[str | None], chars: int) -> Iterator[slice]:
    """Runs of texts of up to `chars` characters together, or of a single longer one."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text or "") + 1
        if held and held + size > chars:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if held:
        yield slice(start, len(texts))


def tag_with_model(
    texts: DataFrame, load: Callable[[], Callable[[list[str]], list[list[dict]]]], chars: int = 1 << 18
) -> DataFrame:
    """Token predictions of a user's model.

    `load` runs once per task and returns a function from a batch of texts to one list of
    predictions (token, label, score, start, end) per text. A batch has at most `chars` characters, unless a single
    text is longer, and its predictions leave the task before the next is asked for.
    """
    columns = ["paper_id", "pos", "token", "label", "score", "start", "end"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            keys, bodies = batch["paper_id"].tolist(), batch["text"].tolist()
            for some in _slices(bodies, chars):
                rows = [
                    (key, pos, p["token"], p["label"], float(p["score"]), int(p["start"]), int(p["end"]))
                    for key, found in zip(keys[some], predict(bodies[some]))
                    for pos, p in enumerate(found)
                ]
                yield pd.DataFrame(rows, columns=columns)

    return texts.select("paper_id", "text").mapInPandas(run, PREDICTIONS)


def tag_with_dictionary(texts: DataFrame, gazetteer: DataFrame, max_words: int = 3) -> DataFrame:
    """Dictionary mentions, one row each: the built-in tagger.

    Every run of up to `max_words` words meets the gazetteer (term, entity_type) in an equi-join,
    which Spark broadcasts when the gazetteer is small enough. Where matches overlap, the one that is
    the longest, then the first, at each of its words stays. Positions count words.
    """
    tokens = texts.select("paper_id", tx.words(F.col("text")).alias("w"))

    def runs_of(n: int) -> Column:
        starts = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: F.struct(
            i.alias("pos"), F.lit(n).alias("n"), F.array_join(F.slice("w", i + 1, n), " ").alias("term")
        ))

    grams = F.flatten(F.array(*[runs_of(n) for n in range(1, max_words + 1)]))
    terms = gazetteer.select(F.lower("term").alias("term"), "entity_type").groupBy("term").agg(
        F.min("entity_type").alias("entity_type")
    )
    matches = tx.unfold(tokens, grams, "g", "paper_id").select("paper_id", "g.*").join(terms, "term")
    if max_words == 1:
        kept = matches
    else:
        covered = matches.withColumn("at", F.explode(F.sequence("pos", F.col("pos") + F.col("n") - 1)))
        # Longer before shorter, then earlier before later, as one number per match.
        strength = F.col("n") * F.lit(2**40) - F.col("pos")
        best = F.max(strength).over(Window.partitionBy("paper_id", "at"))
        kept = (
            covered.withColumn("best", best).filter(F.col("best") == strength)
            .groupBy("paper_id", "pos", "n", "term", "entity_type").agg(F.count(F.lit(1)).alias("won"))
            .filter(F.col("won") == F.col("n"))
        )
    return kept.select(
        F.col("term").alias("entity_text"), "entity_type", F.lit(1.0).alias("confidence"), "paper_id",
        F.col("pos").alias("char_start"), (F.col("pos") + F.col("n")).cast("int").alias("char_end"),
    )


def _kind(label: Column) -> Column:
    return F.substr(label, F.lit(3))


def _cuts(tokens: Column) -> Column:
    """Places of the starts and Os in a chunk, whose tokens come in order. A span starts at B-, at I-
    after O or another type, and at the first token."""

    def place(token: Column, i: Column) -> Column:
        before = F.coalesce(F.get(tokens, i - 1)["label"], F.lit("O"))
        starts = F.startswith(token["label"], F.lit("B-")) | (before == "O") | (
            _kind(before) != _kind(token["label"])
        )
        return F.when((token["label"] == "O") | starts, i)

    return F.array_compact(F.transform(tokens, place))


def _pieces(tokens: Column, cuts: Column, which: Column) -> Column:
    """The pieces of a chunk that begin at the given cuts."""

    def span(k: Column) -> Column:
        i = F.get(cuts, k)
        stop = F.coalesce(F.get(cuts, k + 1), F.size(tokens))
        part = F.slice(tokens, i + 1, stop - i)
        first = F.get(tokens, i)
        return F.struct(
            first["pos"].alias("span"), first["label"].alias("label"),
            F.array_join(F.transform(part, lambda t: t["token"]), " ").alias("text"),
            F.aggregate(part, F.lit(0.0), lambda total, t: total + t["score"]).alias("total"),
            (stop - i).cast("bigint").alias("tokens"),
            ((i == 0) & F.startswith(first["label"], F.lit("I-"))).alias("from_left"),
            (stop == F.size(tokens)).alias("to_right"),
            first["start"].alias("start"), F.get(tokens, stop - 1)["end"].alias("end"),
        )

    return F.transform(which, span)


def _run_pieces(tokens: DataFrame) -> DataFrame:
    """Pieces of spans in each run of tokens that come one after the other in a task: same paper, `pos` rising by one.

    A piece that touches neither end of its run is a whole span. The last piece of a run is always there, with a null label
    if it is no span, and tells the run's first and last `pos`. A row with a null value is a piece without `span`.
    """
    kinds = {f.name: f.dataType.simpleString() for f in tokens.schema}
    schema = (
        f"paper_id {kinds['paper_id']}, span {kinds['pos']}, label string, text string, total double, tokens bigint, "
        f"from_left boolean, to_right boolean, start {kinds['start']}, end {kinds['end']}, run_first long, run_last long"
    )
    names = ["paper_id", "span", "label", "text", "total", "tokens", "from_left", "to_right", "start", "end", "run_first", "run_last"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.ones(batch.num_rows, bool)
            for column in batch.columns:
                if column.null_count:
                    known &= column.is_valid().to_numpy(zero_copy_only=False)
            if not known.all():
                lost = batch.column(0).filter(pa.array(~known))
                yield pa.RecordBatch.from_arrays([lost, *[
                    pa.nulls(len(lost), t) for t in (
                        batch.schema.field("pos").type, pa.string(), pa.string(), pa.float64(), pa.int64(), pa.bool_(), pa.bool_(),
                        batch.schema.field("start").type, batch.schema.field("end").type, pa.int64(), pa.int64(),
                    )
                ]], names)
                batch = batch.filter(pa.array(known))
            n = batch.num_rows
            if not n:
                continue
            paper, pos = batch.column("paper_id"), batch.column("pos").to_numpy(zero_copy_only=False).astype(np.int64)
            coded = batch.column("label").dictionary_encode()
            code, labels = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
            outside, begins, inner = (
                np.array([f(x) for x in labels], bool)[code]
                for f in (lambda x: x == "O", lambda x: x.startswith("B-"), lambda x: x.startswith("I-"))
            )
            types = {x[2:]: i for i, x in enumerate(labels)}
            kind = np.array([types[x[2:]] for x in labels])[code]
            head = np.ones(n, bool)
            head[1:] = pc.not_equal(paper.slice(1), paper.slice(0, n - 1)).to_numpy(zero_copy_only=False) | (pos[1:] != pos[:-1] + 1)
            cut = head | outside | begins
            cut[1:] |= outside[:-1] | (kind[1:] != kind[:-1])
            first = np.flatnonzero(cut)
            stop = np.append(first[1:], n)
            to_right = np.append(head, True)[stop]
            runs = np.flatnonzero(head)
            run_first = pos[runs[np.searchsorted(runs, first, side="right") - 1]]
            keep = ~outside[first] | to_right
            sums = np.add.reduceat(batch.column("score").to_numpy(zero_copy_only=False), first)
            first, stop, to_right, run_first, sums = (x[keep] for x in (first, stop, to_right, run_first, sums))
            words = batch.column("token").to_pylist()
            take = lambda name, at: batch.column(name).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([
                paper.take(pa.array(first)), take("pos", first),
                pa.array([None if o else labels[c][2:] for o, c in zip(outside[first], code[first])], pa.string()),
                pa.array([" ".join(words[i:j]) if j > i + 1 else words[i] for i, j in zip(first.tolist(), stop.tolist())], pa.string()),
                pa.array(sums), pa.array(stop - first), pa.array(head[first] & inner[first]), pa.array(to_right),
                take("start", first), take("end", stop - 1), pa.array(run_first), pa.array(pos[stop - 1]),
            ], names)

    return tokens.select("paper_id", "pos", "token", "label", "score", "start", "end").mapInArrow(decode, schema)


def decode_spans(tokens: DataFrame, chunk: int = 4096) -> DataFrame:
    """Entity spans from B-/I-/O labels of the tokens of each paper, numbered from 0 without gaps.

    B- starts a span; I- continues one of the same type, else starts; O ends. Tokens are decoded where they stand: those
    that come one after the other in a task give whole spans, and only the pieces at the ends of such a run, at most two
    a run, travel and are joined. A paper in which a place is taken twice, or a value is missing, has no such order: its
    tokens are gathered and sorted in chunks of fixed size.
    """
    has_range = "start" in tokens.columns and "end" in tokens.columns
    start, end = (F.col("start"), F.col("end")) if has_range else (F.col("pos"), F.col("pos"))
    token = tokens.select("paper_id", "pos", "token", "label", F.col("score").cast("double").alias("score"), start.alias("start"), end.alias("end"))
    pieces = cut_lineage(_run_pieces(token))
    in_order = Window.partitionBy("paper_id").orderBy("run_first", "span")
    last = pieces.filter("to_right").withColumn("before", F.lag("run_last").over(Window.partitionBy("paper_id").orderBy("run_first")))
    mixed = cut_lineage(last.filter(F.col("before") >= F.col("run_first")).select("paper_id").union(
        pieces.filter("span is null").select("paper_id")
    ).distinct().withColumnRenamed("paper_id", "_mixed"))
    gathered = None
    if not mixed.isEmpty():
        own = F.col("paper_id").eqNullSafe(F.col("_mixed"))
        gathered = _gathered_spans(token.join(mixed, own, "left_semi"), chunk)
        pieces = pieces.join(mixed, own, "left_anti")
    edge = F.col("from_left") | F.col("to_right")
    continues = F.col("from_left") & F.lag("to_right").over(in_order) & (F.lag("label").over(in_order) == F.col("label"))
    spans = pieces.filter(~edge).unionByName(_joined(pieces.filter(edge), continues, in_order), allowMissingColumns=True)
    columns = ["paper_id", "span", "label", "text", "total", "tokens", "start", "end"]
    spans = spans.select(*columns)
    return _shown(spans if gathered is None else spans.unionAll(gathered.select(*columns)), has_range)


def _joined(at_edges: DataFrame, continues: Column, in_order) -> DataFrame:
    """Spans of pieces, each of which continues the one before it or not; pieces without a label are dropped."""
    headed = at_edges.withColumn("head", F.when(~F.coalesce(continues, F.lit(False)), F.col("span")))
    headed = headed.withColumn("head", F.max("head").over(in_order)).filter("label is not null")
    parts_in_order = F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda p: p["text"])
    return headed.groupBy("paper_id", F.col("head").alias("span")).agg(
        F.max("label").alias("label"), F.array_join(parts_in_order, " ").alias("text"),
        F.sum("total").alias("total"), F.sum("tokens").alias("tokens"),
        F.min("start").alias("start"), F.max("end").alias("end"),
    )


def _gathered_spans(tokens: DataFrame, chunk: int) -> DataFrame:
    """Spans of tokens in any order: gathered in chunks of `chunk` places, so no task holds more of a paper at once; the spans
    that touch the edge of a chunk, at most two per chunk, are joined."""
    token = F.struct("pos", "token", "label", "score", "start", "end")
    chunks = tokens.groupBy("paper_id", F.floor(F.col("pos") / chunk).alias("chunk")).agg(
        F.array_sort(F.collect_list(token)).alias("t")
    )
    cut = chunks.withColumn("cuts", _cuts(F.col("t")))

    def pieces(which: Column) -> DataFrame:
        found = _pieces(F.col("t"), F.col("cuts"), which)
        rows = tx.unfold(cut, found, "s", "paper_id", "chunk").select("paper_id", "chunk", "s.*")
        return rows.filter(F.col("label") != "O").withColumn("label", _kind(F.col("label")))

    edge = F.col("from_left") | F.col("to_right")
    last = F.size("cuts") - 1
    at_edges = pieces(F.array_distinct(F.array(F.lit(0), last))).filter(edge)
    inside = pieces(F.sequence(F.lit(0), last)).filter(~edge)
    columns = ["paper_id", "span", "label", "text", "total", "tokens", "start", "end"]
    in_order = Window.partitionBy("paper_id").orderBy("span")
    continues = (
        F.col("from_left") & F.lag("to_right").over(in_order)
        & (F.lag("chunk").over(in_order) == F.col("chunk") - 1)
        & (F.lag("label").over(in_order) == F.col("label"))
    )
    return inside.select(*columns).unionAll(_joined(at_edges, continues, in_order).select(*columns))


def _shown(spans: DataFrame, has_range: bool) -> DataFrame:
    text = F.regexp_replace(F.regexp_replace("text", " ##", ""), "^##", "")
    return spans.select(
        "paper_id", "span", "label", F.trim(text).alias("text"), (F.col("total") / F.col("tokens")).alias("score"),
        "tokens", *(["start", "end"] if has_range else []),
    )


def map_entities(
    spans: DataFrame, threshold: float = fixed.ENTITY_CONFIDENCE, types: Mapping[str, str] = fixed.TAG_TYPES
) -> DataFrame:
    """Confident spans with the entity type their tag stands for; other tags are dropped."""
    mapping = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    start, end = ("start", "end") if "start" in spans.columns else ("span", "span")
    return spans.filter(F.col("score") >= threshold).select(
        F.col("text").alias("entity_text"), F.try_element_at(mapping, F.col("label")).alias("entity_type"),
        F.col("score").alias("confidence"), "paper_id",
        F.col(start).alias("char_start"), F.col(end).alias("char_end"),
    ).filter(F.col("entity_type").isNotNull())


def _normal(mentions: DataFrame) -> DataFrame:
    return mentions.withColumn("entity", tx.normalise_entity(F.col("entity_text")))


def entity_postings(mentions: DataFrame) -> DataFrame:
    """Papers of each entity, one per row, with mention counts: the whole inverted index."""
    return _normal(mentions).groupBy("entity", "paper_id").agg(F.count(F.lit(1)).alias("mentions"))


def entity_index(mentions: DataFrame) -> DataFrame:
    """Each entity with the type of its first mention, its papers and mentions.

    Mentions are first combined per entity and paper, so a very frequent entity spreads over many
    tasks. The paper ids are the rows of `entity_postings`.
    """
    per_paper = _normal(mentions).groupBy("entity", "paper_id").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.min(F.struct("char_start", "entity_type")).alias("first"),
    )
    return per_paper.groupBy("entity").agg(
        F.min(F.struct("paper_id", "first"))["first"]["entity_type"].alias("entity_type"),
        F.count(F.lit(1)).alias("paper_count"), F.sum("mentions").alias("total_mentions"),
    )


def entity_frequency(mentions: DataFrame) -> DataFrame:
    return _normal(mentions).groupBy("entity_type", "entity").agg(
        F.count(F.lit(1)).alias("mentions")
    ).orderBy("entity_type", F.col("mentions").desc(), "entity")


def entity_summary(papers: DataFrame, mentions: DataFrame) -> DataFrame:
    """Totals over the processed papers and their mentions, with unique entities per type."""
    total = papers.agg(F.count(F.lit(1)).alias("n")).scalar()
    per_pair = _normal(mentions).groupBy("entity_type", "entity").agg(F.count(F.lit(1)).alias("m"))
    unique = [
        F.count_if(F.col("entity_type") == t).alias(f"unique_{t.lower()}") for t in fixed.ENTITY_TYPES
    ]
    active = mentions.agg(F.countDistinct("paper_id").alias("n")).scalar()
    return per_pair.agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("total_entity_mentions"),
        F.count(F.lit(1)).alias("unique_entities"), *unique,
    ).withColumns({
        "total_papers": total, "papers_with_entities": active,
        "avg_entities_per_paper": F.coalesce(F.try_divide(F.col("total_entity_mentions"), total), F.lit(0.0)),
    })


def entity_counts(mentions: DataFrame) -> DataFrame:
    """Mentions of each type per paper."""
    return mentions.groupBy("paper_id").agg(*[
        F.count_if(F.col("entity_type") == t).alias(f"{t.lower()}_count") for t in fixed.ENTITY_TYPES
    ])


def entity_arrays(mentions: DataFrame) -> DataFrame:
    """Per paper the sorted distinct entities of each type, as the papers table holds them.

    Mentions become distinct before they are gathered, so an array holds at most the vocabulary of
    one paper, which was a single text to begin with.
    """
    unique = _normal(mentions).select("paper_id", "entity_type", "entity").distinct()

    def gathered(kind: str) -> Column:
        found = F.collect_list(F.when(F.col("entity_type") == kind, F.col("entity")))
        return F.sort_array(found)

    return unique.groupBy("paper_id").agg(*[
        gathered(kind).alias(column)
        for kind, column in zip(fixed.ENTITY_TYPES, ("methods", "datasets", "tasks"))
    ])


def _exploded(papers: DataFrame, kind: str, *keep: str) -> DataFrame:
    items = F.array_distinct(F.transform(ENTITY_COLUMNS[kind], lambda e: F.trim(e)))
    return papers.select(*keep, F.explode(items).alias("entity"))


def trending_entities(papers: DataFrame, kind: str = "method", k: int = 20) -> DataFrame:
    """The entities found in most papers, without stop terms."""
    return (
        _exploded(papers, kind).filter(tx.is_entity(F.col("entity")))
        .groupBy("entity").agg(F.count(F.lit(1)).alias("paper_count"))
        .orderBy(F.col("paper_count").desc(), "entity").limit(k)
    )


def entity_timeline(papers: DataFrame, entity: str, kind: str = "method") -> DataFrame:
    """Papers per month that mention an entity."""
    return (
        papers.filter(F.array_contains(ENTITY_COLUMNS[kind], entity))
        .groupBy(F.col("ingest_year_month").alias("year_month"))
        .agg(F.count(F.lit(1)).alias("paper_count")).orderBy("year_month")
    )


def adoption(
    papers: DataFrame, entities: Sequence[str] | None = None, kind: str = "method",
    start: str | None = None, end: str | None = None,
) -> DataFrame:
    """Papers per entity and month, for chosen entities and a closed month range."""
    rows = papers.withColumnRenamed("ingest_year_month", "year_month")
    if start:
        rows = rows.filter(F.col("year_month") >= start)
    if end:
        rows = rows.filter(F.col("year_month") <= end)
    rows = _exploded(rows, kind, "year_month")
    if entities:
        rows = rows.filter(F.col("entity").isin(list(entities)))
    return rows.groupBy("entity", "year_month").agg(F.count(F.lit(1)).alias("paper_count"))
