"""BM25 relevance search as Spark jobs: many queries at once, over texts or a stored index.

Texts are cut to terms once and written; what is asked of them becomes postings. The best documents of a query are found
without scoring all that share a word with it: see `top_documents`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import text as tx
from corpuslens.functions.stem import porter_stem
from corpuslens.operators import blocks
from corpuslens.session import cut_lineage, discard, freed, working_path

TEXT, KEYWORD = "text", "keyword"
PAPER_FIELDS = {"title": 3.0, "abstract": 1.0}
CANDIDATE_FIELDS = {"title": 1.0, "abstract": 1.0, "topic_cluster": 1.0}
CANDIDATE_KEYWORDS = ("methods", "datasets", "tasks")


def one_query(spark: SparkSession, text: str, query_id: str = "q") -> DataFrame:
    return spark.createDataFrame([(query_id, text)], "query_id string, text string")


def analyse(
    docs: DataFrame, key: str, fields: Sequence[str], keywords: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """One row per document and non-empty field with its array of terms.

    Text is split, lowered and freed of stop words; keyword arrays are taken as they are.
    """
    parts = [
        F.struct(F.lit(f).alias("field"), F.lit(TEXT).alias("kind"), tx.content_words(F.col(f)).alias("terms"))
        for f in fields
    ] + [
        F.struct(
            F.lit(f).alias("field"), F.lit(KEYWORD).alias("kind"),
            F.array_distinct(F.coalesce(f, F.array().cast("array<string>"))).alias("terms"),
        )
        for f in keywords
    ]
    rows = docs.select(F.col(key).alias("doc"), *keep, F.inline(F.array(*parts)))
    return rows.withColumn("len", F.size("terms")).filter(F.col("len") > 0)


def field_stats(analysed: DataFrame) -> DataFrame:
    """Documents and total length of each field."""
    return analysed.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("len").alias("total_len")
    )


def vocabulary(analysed: DataFrame, stem: bool, path: str | None = None) -> DataFrame:
    """Distinct surface forms of text fields with their index term; each is stemmed once.

    Stemming costs far more than moving a word, so the words go to all cores first. The stems are written: a filter on the
    term, which any join on it brings, would else move before `distinct` and stem every occurrence. A caller that names the
    `path` can discard them.
    """
    surfaces = analysed.filter(F.col("kind") == TEXT).select(F.explode("terms").alias("surface")).distinct()
    if not stem:
        return surfaces.withColumn("term", F.col("surface"))
    cores = surfaces.sparkSession.sparkContext.defaultParallelism
    return cut_lineage(surfaces.repartition(cores).withColumn("term", porter_stem(F.col("surface"))), path, free=True)


def query_terms(queries: DataFrame, stem: bool) -> DataFrame:
    """Terms of each query with the number of times they occur in it."""
    found = tx.unfold(queries, tx.content_words(F.col("text")), "surface", "query_id")
    term = porter_stem(F.col("surface")) if stem else F.col("surface")
    return found.select("query_id", term.alias("term")).groupBy("query_id", "term").agg(
        F.count(F.lit(1)).cast("double").alias("weight")
    )


def allowed_edits(term: Column) -> Column:
    """Edits that a query term tolerates by its length."""
    n = F.length(term)
    return F.when(n <= 2, 0).when(n <= 5, 1).otherwise(2)


def _one_less(term: Column) -> Column:
    """Every string that lacks one letter of `term`."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(term), F.lit(1))),
        lambda i: F.concat(F.substring(term, F.lit(1), i - 1), F.substring(term, i + 1, F.length(term))),
    )


def _shapes(words: DataFrame, word: str, edits: Column) -> DataFrame:
    """Every word with itself and what remains of it after up to `edits` deletions, one per row."""
    none = F.array().cast("array<string>")
    once = words.withColumn("less", F.array_distinct(_one_less(F.col(word))))
    twice = F.flatten(F.transform("less", lambda w: _one_less(w)))
    every = F.concat(
        F.array(word), F.when(edits >= 1, F.col("less")).otherwise(none), F.when(edits >= 2, twice).otherwise(none)
    )
    return tx.unfold(once, F.array_distinct(every), "shape", *words.columns)


def expand_fuzzy(terms: DataFrame, wanted: DataFrame) -> DataFrame:
    """Index terms within the allowed edits of each wanted term, with a weight that falls with them.

    Two strings within d edits share a string that lacks at most d letters of each. So both sides
    list what remains after deletions, meet in an equi-join, and only those pairs are measured. Words
    whose length no wanted term can reach match nothing and list nothing.
    """
    asked = wanted.select("term").distinct().withColumn("edits", allowed_edits(F.col("term")))
    n = F.length("term")
    reach = asked.agg(F.struct(
        F.min(n - F.col("edits")).alias("lo"), F.max(n + F.col("edits")).alias("hi"), F.max("edits").alias("most")
    ).alias("r")).scalar()
    near = terms.select(F.col("term").alias("found")).distinct().filter(
        F.length("found").between(reach["lo"], reach["hi"])
    )
    left = _shapes(asked, "term", F.col("edits"))
    right = _shapes(near, "found", reach["most"])
    pairs = left.join(right, "shape").select("term", "edits", "found").distinct()
    distance = F.levenshtein("term", "found")
    close = pairs.withColumn("distance", distance).filter(F.col("distance") <= F.col("edits"))
    return close.select(
        "term", "found", "distance",
        (1 - F.col("distance") / F.least(F.length("term"), F.length("found"))).alias("similarity"),
    ).filter(F.col("similarity") > 0)


KEYS = ["field", "kind", "term"]
#: Ranks compare scores rounded to nine digits, so what is within a digit of the bar must stay.
SLACK = 1e-8


def term_counts(analysed: DataFrame, wanted: DataFrame) -> DataFrame:
    """How often each wanted index term occurs in each document field.

    `wanted(kind, surface, term)` is small for few queries; Spark then broadcasts it by its size and
    only the matches are shuffled.
    """
    rows = analysed.select("doc", "field", "kind", "len", F.explode("terms").alias("surface"))
    return rows.join(wanted, ["kind", "surface"]).groupBy("doc", "field", "kind", "len", "term").agg(
        F.count(F.lit(1)).alias("tf")
    )


def _averages(stats: DataFrame) -> DataFrame:
    """One row per field, so its size is fixed by the call."""
    return F.broadcast(stats.select("field", F.col("n_docs").alias("n"), (F.col("total_len") / F.col("n_docs")).alias("avg_len")))


def gain(tf: Column, length: Column) -> Column:
    """What a term's occurrences are worth, before its rarity. Keyword fields have no length norm."""
    norm = F.when(F.col("kind") == KEYWORD, F.lit(1.0)).otherwise(1 - fixed.BM25_B + fixed.BM25_B * length / F.col("avg_len"))
    return tf * (fixed.BM25_K1 + 1) / (tf + fixed.BM25_K1 * norm)


def postings(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """(doc, field, kind, term, gain) of each count."""
    return counts.join(_averages(stats), "field").select("doc", *KEYS, gain(F.col("tf"), F.col("len")).alias("gain"))


def term_bounds(found: DataFrame) -> DataFrame:
    """Documents of each term of a field, and the most that one of them gains by it."""
    return found.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("df"), F.max("gain").alias("top"))


def query_weights(bounds: DataFrame, stats: DataFrame, asked: DataFrame, boosts: Mapping[str, float]) -> DataFrame:
    """(query_id, field, kind, term, weight, df, top): what a query pays for each unit of gain.

    `asked(query_id, kind, term, weight)` lists index terms.
    """
    boost = F.create_map(*[F.lit(x) for pair in boosts.items() for x in pair])
    n, seen = F.col("n"), F.col("df")
    rarity = F.ln(1 + (n - seen + 0.5) / (seen + 0.5))
    priced = bounds.join(_averages(stats), "field").select(
        *KEYS, "df", "top", (rarity * F.try_element_at(boost, F.col("field"))).alias("price")
    )
    return asked.join(priced, ["kind", "term"]).select(
        "query_id", *KEYS, (F.col("weight") * F.col("price")).alias("weight"), "df", "top"
    )


def all_documents(found: DataFrame, weights: DataFrame) -> DataFrame:
    """Score of each query and document that share a term: the best field's sum over the query's terms."""
    sums = found.join(weights, KEYS).groupBy("query_id", "doc", "field").agg(F.sum(F.col("weight") * F.col("gain")).alias("s"))
    return sums.groupBy("query_id", "doc").agg(F.max("s").alias("score"))


def bars(found: DataFrame, weights: DataFrame, promising: DataFrame, k: int) -> DataFrame:
    """(query_id, bar): a score that at least `k` documents of the query reach, or 0 if no such is known.

    The best twice `k` of `promising(query_id, doc, score)` are scored by all terms; the k-th best of these scores is the bar.
    """
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    # Few and written, so that Spark knows it: only the postings of these documents are shuffled.
    leading = cut_lineage(
        promising.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= 2 * k).select("query_id", "doc"), free=True
    )
    theirs = found.join(leading.select("doc").distinct(), "doc", "left_semi")
    paid = leading.join(weights.select("query_id", *KEYS, "weight"), "query_id").join(theirs, ["doc", *KEYS])
    sums = paid.groupBy("query_id", "doc", "field").agg(F.sum(F.col("weight") * F.col("gain")).alias("s"))
    scored = sums.groupBy("query_id", "doc").agg(F.max("s").alias("score")).withColumn("place", F.row_number().over(best))
    return scored.filter(F.col("place") <= k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(F.lit(0.0)).alias("bar")
    )


def rarest_terms(weights: DataFrame, k: int, seeds: int = 3) -> DataFrame:
    """The rarest terms of each query, as many as it takes to name `seeds` times `k` documents."""
    order = Window.partitionBy("query_id").orderBy("df", *KEYS)
    before = F.coalesce(F.sum("df").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return weights.withColumn("before", before).filter(F.col("before") < seeds * k).select("query_id", *KEYS, "weight")


def split_terms(weights: DataFrame, bar: DataFrame) -> DataFrame:
    """The weights with `needed` and `rest`: a field's terms from the least that they can give, as long as all of them
    together stay below the bar, aren't needed to find a document; `rest` is their sum."""
    climb = Window.partitionBy("query_id", "field").orderBy("most", "kind", "term").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("query_id", "field")
    judged = weights.withColumn("most", F.col("weight") * F.col("top")).join(bar, "query_id", "left").withColumn(
        "bar", F.coalesce("bar", F.lit(0.0)) - SLACK
    ).withColumn("needed", F.sum("most").over(climb) >= F.col("bar"))
    return judged.withColumn("rest", F.coalesce(F.sum(F.when(~F.col("needed"), F.col("most"))).over(whole), F.lit(0.0)))


def survivors(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, doc, field, s, rest) of the documents that can still reach the bar: `s` is what the needed terms give, and
    what the others can add at most would be enough."""
    needed = terms.filter("needed")
    bounds = needed.groupBy("query_id", "field").agg(F.max("rest").alias("rest"), F.max("bar").alias("bar"))
    paid = cut_lineage(needed.select("query_id", *KEYS, "weight"), free=True)
    sums = found.join(paid, KEYS).groupBy("query_id", "doc", "field").agg(F.sum(F.col("weight") * F.col("gain")).alias("s"))
    return sums.join(cut_lineage(bounds, free=True), ["query_id", "field"]).filter(F.col("s") + F.col("rest") >= F.col("bar")).drop("bar")


def raised(found: DataFrame, weights: DataFrame, left: DataFrame, k: int) -> DataFrame:
    """The survivors that also reach the bar of those with the best sums so far."""
    promising = left.groupBy("query_id", "doc").agg(F.max("s").alias("score"))
    bar = bars(found, weights, promising, k)
    return left.join(bar, "query_id").filter(F.col("s") + F.col("rest") >= F.col("bar") - SLACK).drop("bar")


def top_documents(found: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """The best `k` documents of each query, exactly, without scoring all that match.

    Rare terms first: they lead to documents whose scores give each query a bar. Common terms that can't reach the bar even
    together are not needed to find a document, so their postings are met only by the documents that the other terms
    left, after these have raised the bar once more. Each step is a join and an aggregate over all queries; nothing is cut
    off by a guess. What the queries pay is written, so that Spark knows that it is small next to the postings, and the
    shuffle files of each step are removed when it ends.
    """
    weights = cut_lineage(weights, free=True)
    rare = all_documents(found, cut_lineage(rarest_terms(weights, k), free=True))
    terms = cut_lineage(split_terms(weights, bars(found, weights, rare, k)), free=True)
    spark, wide = found.sparkSession, working_path(found.sparkSession, "survivors")
    left = cut_lineage(survivors(found, terms), wide, free=True)
    left = cut_lineage(raised(found, weights, left, k), free=True).drop("rest")
    discard(spark, wide)
    spare = terms.filter(~F.col("needed")).select("query_id", *KEYS, "weight")
    more = left.join(spare, ["query_id", "field"]).join(found, ["doc", *KEYS]).select(
        "query_id", "doc", "field", (F.col("weight") * F.col("gain")).alias("s")
    )
    sums = left.unionByName(more).groupBy("query_id", "doc", "field").agg(F.sum("s").alias("s"))
    return top_per_query(sums.groupBy("query_id", "doc").agg(F.max("s").alias("score")), k)


def top_per_query(scores: DataFrame, k: int | None, digits: int = 9) -> DataFrame:
    """The best `k` documents of each query; ties, up to rounding, go by key."""
    if k is None:
        return scores
    order = Window.partitionBy("query_id").orderBy(F.round("score", digits).desc(), F.col("doc"))
    return scores.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def search(
    docs: DataFrame, queries: DataFrame, fields: Mapping[str, float] | None = None,
    keywords: Sequence[str] = (), k: int | None = 20, key: str = "paper_id", stem: bool = True,
    fuzzy: bool = False, keep: Column | None = None,
) -> DataFrame:
    """Best documents for every row of `queries(query_id, text)`.

    `fields` gives the boost of each text field; keyword arrays match a whole query text. `keep`
    restricts the hits, but not the statistics.
    """
    boosts = dict(fields or PAPER_FIELDS)
    # The vocabulary, the totals and the counts all read the terms; so the texts are analysed once.
    analysed = cut_lineage(analyse(docs, key, list(boosts), keywords))
    asked = query_terms(queries, stem).withColumn("kind", F.lit(TEXT))
    if stem or fuzzy:
        words = vocabulary(analysed, stem)
        if fuzzy:
            near = expand_fuzzy(words, asked)
            asked = asked.join(near, "term").groupBy("query_id", "kind", F.col("found").alias("term")).agg(
                F.sum(F.col("weight") * F.col("similarity")).alias("weight")
            )
        asked = cut_lineage(asked)
        wanted = words.join(asked.select("term").distinct(), "term").select(
            F.lit(TEXT).alias("kind"), "surface", "term"
        )
    else:
        wanted = asked.select("kind", F.col("term").alias("surface"), "term").distinct()
    if keywords:
        whole = queries.select("query_id", F.col("text").alias("term"), F.lit(1.0).alias("weight"))
        whole = whole.withColumn("kind", F.lit(KEYWORD))
        asked = asked.unionByName(whole)
        wanted = wanted.unionByName(whole.select("kind", F.col("term").alias("surface"), "term").distinct())
        boosts.update({f: 1.0 for f in keywords})
    stats = field_stats(analysed)
    found = cut_lineage(postings(term_counts(analysed, wanted), stats))
    weights = query_weights(term_bounds(found), stats, asked, boosts)
    if keep is not None:
        found = found.join(docs.filter(keep).select(F.col(key).alias("doc")), "doc", "left_semi")
    hits = all_documents(found, weights) if k is None else top_documents(found, weights, k)
    return hits.withColumnRenamed("doc", key)


def candidates(papers: DataFrame, queries: DataFrame, k: int = 200, stem: bool = True) -> DataFrame:
    """Papers that match any query word in title, abstract, topic, or a whole entity name."""
    return search(papers, queries, CANDIDATE_FIELDS, CANDIDATE_KEYWORDS, k=k, stem=stem)


def section_rows(fulltext: DataFrame) -> DataFrame:
    """One row per section; the key names paper and place."""
    rows = fulltext.select("paper_id", F.posexplode("sections").alias("pos", "section"))
    return rows.select(
        "paper_id", "pos", F.col("section.heading").alias("heading"), F.col("section.text").alias("text"),
        F.concat_ws("#", "paper_id", "pos").alias("section_id"),
    )


def section_search(
    fulltext: DataFrame, queries: DataFrame, heading: str | None = None, k: int | None = 20, stem: bool = True
) -> DataFrame:
    """Papers by their best section. With `heading`, only sections that carry one of its words count,
    so heading and body match inside the same section."""
    rows = section_rows(fulltext)
    keep = None
    if heading:
        keep = F.arrays_overlap(tx.words(F.col("heading")), tx.words(F.lit(heading)))
    hits = search(rows, queries, {"text": 1.0}, k=None, key="section_id", stem=stem, keep=keep)
    paper = F.regexp_replace("section_id", r"#\d+$", "")
    best = hits.groupBy("query_id", paper.alias("doc")).agg(F.max("score").alias("score"))
    return top_per_query(best, k).withColumnRenamed("doc", "paper_id")


def fulltext_search(fulltext: DataFrame, queries: DataFrame, k: int | None = 20, stem: bool = True) -> DataFrame:
    return search(fulltext, queries, {"full_text": 1.0}, k=k, stem=stem)


def related_by_topic(papers: DataFrame, k: int = 4, fetched: int = 6, stem: bool = True) -> DataFrame:
    """For every paper the best hits for its topic's name, without itself.

    Each topic is searched once; its few hits then join the papers, whatever the size of the topic.
    """
    named = papers.filter(F.coalesce("topic_cluster", F.lit("outlier")) != "outlier")
    topics = named.select(F.col("topic_cluster").alias("query_id"), F.col("topic_cluster").alias("text")).distinct()
    hits = search(papers, topics, k=fetched, stem=stem)
    listed = hits.groupBy(F.col("query_id").alias("topic_cluster")).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("place", F.col("paper_id").alias("id")))), lambda h: h["id"]
        ).alias("hits")
    )
    others = F.slice(F.filter("hits", lambda h: h != F.col("paper_id")), 1, k)
    return named.join(listed, "topic_cluster").select("paper_id", F.posexplode(others).alias("place", "related_id"))


#: Parts of a stored month; a term's part is a hash of it.
BUCKETS = 16


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_index(
    papers: DataFrame, path: str, months: Sequence[str] | None = None, stem: bool = True, buckets: int = BUCKETS
) -> None:
    """Write the index of the papers, or of some months, replacing just those months.

    Three tables: `postings` by month and hash of the term, sorted by term, with a row for each term of a field and chunk of
    documents (see `blocks`); `terms` with the documents of each term, its largest count and the least length, from which a
    search bounds its gain; and `totals` of the fields. Each part of a replaced month gets a row without a document, so that
    parts that lost all their terms are replaced as well.

    Papers of a month are brought together before they are analysed; from then on only a chunk's list of words, the
    numbers of a chunk and rows of `terms` are shuffled, and what a step leaves behind is removed when the next has ended.
    """
    spark = papers.sparkSession
    rows = papers if months is None else papers.filter(F.col("ingest_year_month").isin(list(months)))
    rows = rows.select("paper_id", *PAPER_FIELDS, "ingest_year_month")
    kept = {name: working_path(spark, name) for name in ("repeated", "copies", "once", "merged", "words", "named", "known")}

    def cut(name: str, df: DataFrame) -> DataFrame:
        # A chunk is one row, so few of them may be read at once.
        return cut_lineage(df, kept[name], free=True, compression="zstd", **{"parquet.block.size": str(1 << 24)})

    def analysed(some: DataFrame) -> DataFrame:
        return analyse(some, "paper_id", list(PAPER_FIELDS), keep=["ingest_year_month"])

    # Texts of one id, field and length count as one document: they are added up before they get into a chunk.
    key = ["ingest_year_month", "paper_id"]
    repeated = cut("repeated", rows.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(*key))
    copies, alone = None, rows
    if not repeated.isEmpty():
        same = [rows[c].eqNullSafe(repeated[c]) for c in key]
        alone, copies = rows.join(repeated, same, "left_anti"), cut("copies", analysed(rows.join(repeated, same, "left_semi")))
    encoded = cut("once", blocks.chunks(
        analysed(alone.hint("rebalance", "ingest_year_month")).withColumn("ns", F.lit(None).cast("array<int>"))
    ))
    counted = blocks.chunk_rows(encoded)
    if copies is not None:
        document = ["ingest_year_month", "doc", "field", "len"]
        summed = copies.select(*document, F.explode("terms").alias("surface")).groupBy(*document, "surface").agg(
            F.count(F.lit(1)).cast("int").alias("n")
        ).groupBy(*document).agg(F.collect_list(F.struct("surface", "n")).alias("w"))
        merged = summed.select(*document, F.col("w.surface").alias("terms"), F.col("w.n").alias("ns"))
        encoded = encoded.unionByName(cut("merged", blocks.chunks(merged, 1 << 62)))
        counted = counted.unionByName(copies.select(*document))
    if stem:
        listed = encoded.select("chunk", F.posexplode("words").alias("at", "surface"))
        words = vocabulary(listed.select(F.lit(TEXT).alias("kind"), F.array("surface").alias("terms")), stem, kept["words"])
        named = cut("named", listed.join(words, "surface").groupBy("chunk").agg(
            F.array_sort(F.collect_list(F.struct("at", "term"))).alias("w")
        ).select("chunk", F.col("w.term").alias("terms")))
        encoded = encoded.join(named, "chunk")
    else:
        encoded = encoded.withColumnRenamed("words", "terms")
    found = blocks.inverted(encoded).withColumn("bucket", _bucket(F.col("term"), buckets))
    totals = counted.groupBy("ingest_year_month", "field").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("len").alias("total_len")
    )
    touched = spark.createDataFrame([(m,) for m in months or []], "ingest_year_month string").coalesce(1)
    parts = touched.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))

    def put(name: str, table: DataFrame, mark: DataFrame, *by: str) -> None:
        order = [*by, *(["term"] if "term" in table.columns else [])]
        with freed(spark):
            table.unionByName(mark, allowMissingColumns=True).sortWithinPartitions(*order).write.option("compression", "zstd").option(
                "partitionOverwriteMode", "static" if months is None else "dynamic"
            ).mode("overwrite").partitionBy(*by).parquet(f"{path}/{name}")

    by = ["ingest_year_month", "bucket"]
    put("totals", totals.hint("rebalance", by[0]), touched, by[0])
    put("postings", found, parts, *by)
    for name in ("copies", "once", "merged", "words", "named"):
        discard(spark, kept[name])
    stored = spark.read.schema(STORED["postings"]).parquet(f"{path}/postings").filter("term is not null")
    if months is not None:
        stored = stored.filter(F.col("ingest_year_month").isin(list(months)))
    known = cut("known", stored.groupBy(*by, "field", "term").agg(
        F.sum("df").alias("df"), F.max("most_tf").cast("long").alias("most_tf"), F.min("least_len").alias("least_len")
    ))
    put("terms", known.hint("rebalance", *by), parts, *by)
    for name in kept:
        discard(spark, kept[name])


#: Columns of the stored tables; reading by them opens no file for its schema.
STORED = {
    "postings": "field string, term string, docs array<string>, lens array<int>, tfs array<int>, df int, most_tf int, "
    "least_len int, ingest_year_month string, bucket int",
    "terms": "field string, term string, df long, most_tf long, least_len int, ingest_year_month string, bucket int",
    "totals": "field string, n_docs long, total_len long, ingest_year_month string",
}


def index_part(spark: SparkSession, path: str, name: str, wanted: DataFrame) -> DataFrame:
    """Rows of a stored table for `wanted(bucket, term)`; folders of other buckets are not opened."""
    # At most as many numbers as there are buckets, known before the scan starts.
    asked = wanted.agg(F.collect_set("bucket").alias("b")).scalar()
    rows = spark.read.schema(STORED[name]).parquet(f"{path}/{name}").filter(F.array_contains(asked, F.col("bucket")))
    return rows.join(wanted, ["bucket", "term"], "left_semi").withColumn("kind", F.lit(TEXT))


def search_index(
    spark: SparkSession, path: str, queries: DataFrame, k: int | None = 20, stem: bool = True, buckets: int = BUCKETS
) -> DataFrame:
    """The same ranking from a stored index; `buckets` as it was built with.

    Only the parts that hold a hash of an asked term are read, and of `postings` just once: document frequencies and bounds
    come from `terms`, and what the terms select is written for the steps after it.
    """
    asked = cut_lineage(query_terms(queries, stem).withColumn("kind", F.lit(TEXT)))
    wanted = asked.select("term").distinct().withColumn("bucket", _bucket(F.col("term"), buckets))
    stats = spark.read.schema(STORED["totals"]).parquet(f"{path}/totals").filter("field is not null").groupBy("field").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len")
    )
    known = index_part(spark, path, "terms", wanted).groupBy(*KEYS).agg(
        F.sum("df").alias("df"), F.max("most_tf").alias("most_tf"), F.min("least_len").alias("least_len")
    )
    lists = F.arrays_zip(F.col("docs").alias("doc"), F.col("lens").alias("len"), F.col("tfs").alias("tf"))
    counts = index_part(spark, path, "postings", wanted).select(*KEYS, F.inline(lists)).filter("doc is not null")
    found = cut_lineage(postings(counts, stats), free=True, compression="zstd")
    # More occurrences and a shorter field gain more, so the best of both bounds every document's gain; but no document
    # may have both, and a bound that is too high makes common terms needed. What is written tells the most that one gains.
    most = found.groupBy(*KEYS).agg(F.max("gain").alias("_most"))
    bounds = known.join(_averages(stats), "field").join(most, KEYS).select(
        *KEYS, "df", F.least(gain(F.col("most_tf"), F.col("least_len")), F.col("_most")).alias("top")
    )
    weights = query_weights(bounds, stats, asked, PAPER_FIELDS)
    hits = all_documents(found, weights) if k is None else top_documents(found, weights, k)
    return hits.withColumnRenamed("doc", "paper_id")
