from __future__ import annotations

import math
import os
import random
import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuslens import session
from corpuslens.functions import fixed_values as fixed
from corpuslens.functions.stem import porter_stem
from corpuslens.operators import blocks, search
from porter import porter

WORDS = (
    "learning learned learns graph graphs neural networks network model models modelling data the of and "
    "ranking ranked citation citations topic topical"
).split()


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    return [
        (
            f"p{i:02d}", " ".join(rng.choices(WORDS, k=rng.randrange(0, 5))),
            " ".join(rng.choices(WORDS, k=rng.randrange(1, 30))), f"topic_{i % 4}",
            [rng.choice(["BERT", "graph model"])], ["MNIST"], None, "2024-0" + str(1 + i % 3),
        )
        for i in range(n)
    ]


def papers(spark):
    return spark.createDataFrame(
        corpus(),
        "paper_id string, title string, abstract string, topic_cluster string, methods array<string>, "
        "datasets array<string>, tasks array<string>, ingest_year_month string",
    )


def terms(text):
    found = [t for t in re.split(r"[^\w]+|_", text.lower()) if t]
    return [porter(t) for t in found if t not in fixed.STOP_WORDS]


def bm25(query, boosts, docs):
    """Best field of each document, field by field and term by term."""
    asked = Counter(terms(query))
    best = {}
    for field, boost in boosts.items():
        rows = {d: terms(t[field]) for d, t in docs.items() if terms(t[field])}
        mean = sum(map(len, rows.values())) / len(rows)
        df = Counter(t for r in rows.values() for t in set(r))
        for d, r in rows.items():
            tf = Counter(r)
            s = sum(
                w * math.log(1 + (len(rows) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2
                / (tf[t] + 1.2 * (0.25 + 0.75 * len(r) / mean))
                for t, w in asked.items() if tf[t]
            ) * boost
            if s:
                best[d] = max(best.get(d, 0.0), s)
    return best


def docs():
    return {r[0]: {"title": r[1], "abstract": r[2], "topic_cluster": r[3]} for r in corpus()}


def scores(df, query="q"):
    return {r.paper_id: r.score for r in df.collect() if r.query_id == query}


def close(a, b):
    return a.keys() == b.keys() and all(math.isclose(a[k], b[k], rel_tol=1e-9) for k in a)


def test_stemmed_search_equals_brute_force(spark):
    queries = spark.createDataFrame(
        [("q", "Learning ranked graphs graphs"), ("r", "modelled citation"), ("none", "xyzzy the")],
        "query_id string, text string",
    )
    got = search.search(papers(spark), queries, k=None)
    for q, text in (("q", "Learning ranked graphs graphs"), ("r", "modelled citation")):
        assert close(scores(got, q), bm25(text, search.PAPER_FIELDS, docs()))
    assert scores(got, "none") == {}


def test_index_gives_the_same_ranking(spark, tmp_path):
    path = str(tmp_path / "index")
    df = papers(spark)
    search.build_index(df, path)
    changed = df.withColumn("abstract", F.when(F.col("ingest_year_month") == "2024-02", "neural data").otherwise(F.col("abstract")))
    search.build_index(changed, path, ["2024-02"])
    query = search.one_query(spark, "neural networks data")
    assert close(
        scores(search.search_index(spark, path, query, None)), scores(search.search(changed, query, k=None))
    )


def test_keyword_fields_match_the_whole_query(spark):
    got = search.candidates(papers(spark), search.one_query(spark, "graph model"), k=200)
    text = bm25("graph model", search.CANDIDATE_FIELDS, docs())
    tagged = {r[0] for r in corpus() if r[4] == ["graph model"]}
    n, df = 60, len(tagged)
    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
    want = {d: max(text.get(d, 0.0), idf if d in tagged else 0.0) for d in set(text) | tagged}
    assert close(scores(got), want)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_fuzzy_pairs_equal_all_pairs(spark):
    rng = random.Random(7)
    vocabulary = sorted({"".join(rng.choices("abé", k=rng.randrange(1, 9))) for _ in range(250)} | {"a" * 40})
    wanted = sorted({"".join(rng.choices("abé", k=rng.randrange(1, 9))) for _ in range(40)})
    got = search.expand_fuzzy(
        spark.createDataFrame([(w,) for w in vocabulary], "term string"),
        spark.createDataFrame([(w,) for w in wanted], "term string"),
    ).collect()

    def allowed(w):
        return 0 if len(w) <= 2 else 1 if len(w) <= 5 else 2

    want = {
        (w, v, edits(w, v)) for w in wanted for v in vocabulary
        if edits(w, v) <= allowed(w) and edits(w, v) < min(len(w), len(v))
    }
    assert {(r.term, r.found, r.distance) for r in got} == want


def test_category_filter_keeps_statistics(spark):
    query = search.one_query(spark, "neural graph")
    every = scores(search.search(papers(spark), query, k=None))
    some = scores(search.search(papers(spark), query, k=None, keep=F.col("topic_cluster") == "topic_1"))
    chosen = {r[0] for r in corpus() if r[3] == "topic_1"}
    assert close(some, {d: s for d, s in every.items() if d in chosen})


def test_section_needs_heading_and_body_together(spark):
    rows = [
        ("a", [("Limitations", "domain shift hurts"), ("Intro", "nothing")]),
        ("b", [("Limitations", "nothing"), ("Intro", "domain shift here")]),
    ]
    df = spark.createDataFrame(rows, "paper_id string, sections array<struct<heading: string, text: string>>")
    got = search.section_search(df, search.one_query(spark, "domain shifts"), heading="limitations")
    assert [r.paper_id for r in got.collect()] == ["a"]


def zipf_corpus(spark, n, seed):
    """Documents over a vocabulary with a few very common words."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [(f"d{i:04d}", " ".join(rng.choices(vocabulary, weights, k=3)), " ".join(rng.choices(vocabulary, weights, k=rng.randint(5, 60)))) for i in range(n)]
    queries = [(f"q{i:02d}", " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 12)))) for i in range(40)] + [("none", "zzz"), ("one", "w0")]
    return spark.createDataFrame(rows, "paper_id string, title string, abstract string"), spark.createDataFrame(queries, "query_id string, text string")


@pytest.mark.parametrize("k", [1, 7, 5000])
def test_pruned_ranking_equals_the_full_one(spark, k):
    docs, queries = zipf_corpus(spark, 600, k)
    full = search.top_per_query(search.search(docs, queries, k=None, stem=False).withColumnRenamed("paper_id", "doc"), k).collect()
    pruned = search.search(docs, queries, k=k, stem=False).collect()
    as_rows = lambda rows, key: sorted((r.query_id, r.place, r[key], round(r.score, 9)) for r in rows)
    assert as_rows(pruned, "paper_id") == as_rows(full, "doc")


def test_pruning_leaves_few_documents(spark):
    """What is joined and shuffled is far below queries times matches."""
    docs, queries = zipf_corpus(spark, 4000, 1)
    analysed = search.analyse(docs, "paper_id", ["abstract"])  # titles of three words tie by the hundred
    asked = search.query_terms(queries, False).withColumn("kind", F.lit(search.TEXT))
    stats = search.field_stats(analysed)
    found = search.postings(search.term_counts(analysed, asked.select("kind", F.col("term").alias("surface"), "term").distinct()), stats).cache()
    weights = search.query_weights(search.term_bounds(found), stats, asked, search.PAPER_FIELDS).cache()
    matches = search.all_documents(found, weights).count()
    joined = found.join(weights, search.KEYS).count()
    rare = search.all_documents(found, search.rarest_terms(weights, 10))
    terms = search.split_terms(weights, search.bars(found, weights, rare, 10)).cache()
    needed = found.join(terms.filter("needed"), search.KEYS).count()
    left = search.raised(found, weights, search.survivors(found, terms), 10).count()
    assert needed < joined / 4 and left < matches / 10


def test_stems_equal_the_published_steps(spark):
    rng = random.Random(1)
    ends = "sses ies ss s eed ed ing y ational tional izer ousli ization ator iviti icate alize ical ness ance ement ion ive e ll".split()
    made = {"".join(rng.choice("aeiouybcdlmrstwxzé") for _ in range(rng.randint(1, 6))) + "".join(rng.choices(ends, k=rng.randint(0, 2))) for _ in range(4000)}
    made |= {"caresses", "ponies", "agreed", "hopping", "falling", "filing", "sky", "happy", "relational", "a", ""} | {"y" * k + "ing" for k in range(9)}
    rows = spark.createDataFrame([(w,) for w in made], "w string").select("w", porter_stem(F.col("w")).alias("s")).collect()
    assert [(r.w, r.s) for r in rows if r.s != porter(r.w)] == []


def test_the_index_opens_only_the_buckets_of_asked_terms(spark, tmp_path):
    path = str(tmp_path / "index")
    search.build_index(papers(spark), path, stem=False)
    query = search.one_query(spark, "neural networks")
    want = scores(search.search_index(spark, path, query, None, stem=False))
    asked = {r[0] for r in spark.createDataFrame([("neural",), ("networks",)], "t string").select(search._bucket(F.col("t"), search.BUCKETS)).collect()}
    broken = 0
    for file in (tmp_path / "index" / "postings").rglob("*.parquet"):
        if int(file.parent.name.removeprefix("bucket=")) not in asked:
            file.write_bytes(b"no parquet")  # would stop whatever opens it
            broken += 1
    assert broken and want
    assert close(scores(search.search_index(spark, path, query, None, stem=False)), want)
    wanted = spark.createDataFrame([("neural", min(asked))], "term string, bucket int")
    plan = search.index_part(spark, path, "postings", wanted)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and re.search(r"PartitionFilters: \[[^]]*bucket", plan)


def test_the_index_leaves_nothing_else_and_moves_no_occurrence(spark, tmp_path):
    """Steps of the build are removed with their shuffle files, and what it shuffles does not grow with how often words occur."""
    shared = Path(session.shared_dir(spark)) / "corpuslens"
    docs, _ = zipf_corpus(spark, 50, 2)
    docs = docs.withColumn("ingest_year_month", F.lit("2024-01"))
    before = set(os.listdir(shared)) if shared.exists() else set()
    search.build_index(docs, str(tmp_path / "i"))
    assert set(os.listdir(shared)) == before
    rows = spark.read.schema(search.STORED["postings"]).parquet(str(tmp_path / "i" / "postings")).filter("term is not null")
    assert rows.count() == rows.select("field", "term").distinct().count() < rows.agg(F.sum("df")).first()[0] / 2


def test_repeated_and_null_ids_and_empty_texts_are_indexed_as_they_are_searched(spark, tmp_path):
    rows = [
        ("a", "Running graphs", "the graph runs and runs", "m1"), ("a", "Running graphs", "the graph runs and runs", "m1"),
        ("a", "graph", "data", "m1"), ("a", "graph run", "data graph", "m2"), ("b", None, "graphs " * 50 + "data", "m1"),
        ("b", "", None, "m2"), ("c", "the", "of", "m1"), ("d", "😀 é data", "graphed", None),
    ]
    df = spark.createDataFrame(rows, "paper_id string, title string, abstract string, ingest_year_month string")
    query = spark.createDataFrame([("q", "graph running data"), ("r", "é graphs"), ("s", "of the")], "query_id string, text string")
    for stem in (True, False):
        # A plain search adds up all months of an id, so each month has ids of its own here.
        named = df.withColumn("paper_id", F.concat_ws("-", "paper_id", "ingest_year_month"))
        search.build_index(named, str(tmp_path / f"i{stem}"), stem=stem)
        found = search.search_index(spark, str(tmp_path / f"i{stem}"), query, None, stem=stem).collect()
        wanted = search.search(named, query, k=None, stem=stem).collect()
        as_rows = lambda hits: sorted((h.query_id, h.paper_id, round(h.score, 9)) for h in hits)
        assert as_rows(found) == as_rows(wanted) and len(found) > 4
    nobody = spark.createDataFrame([(None, "graph", "data", "m1"), (None, "graph", "data", "m1"), ("a", "graph", "x", "m1")], df.schema)
    search.build_index(nobody, str(tmp_path / "n"))
    assert [h.paper_id for h in search.search_index(spark, str(tmp_path / "n"), search.one_query(spark, "graph"), None).collect()] == ["a"]
    known = spark.read.schema(search.STORED["terms"]).parquet(str(tmp_path / "n" / "terms")).filter("term = 'graph'").collect()
    assert [(r.df, r.most_tf, r.least_len) for r in known] == [(2, 2, 1)]  # both without an id are one document
    totals = spark.read.schema(search.STORED["totals"]).parquet(str(tmp_path / "n" / "totals"))
    assert sorted((r.field, r.n_docs, r.total_len) for r in totals.collect()) == [("abstract", 3, 3), ("title", 3, 3)]
    search.build_index(nobody.filter("false"), str(tmp_path / "e"))
    assert search.search_index(spark, str(tmp_path / "e"), search.one_query(spark, "graph"), None).collect() == []


def test_chunks_are_cut_by_places_and_lose_no_row(monkeypatch):
    monkeypatch.setattr(blocks, "PLACES", 10)
    sizes = [3, 9, 0, 25, 1, 1, 1, 10, 2]
    rows = [{"terms": ["w"] * n, "i": i} for i, n in enumerate(sizes)]
    batches = [pa.RecordBatch.from_pylist(rows[a:b]) for a, b in ((0, 4), (4, 4), (4, 9)) if a < b]
    cut = [t["i"].to_pylist() for t in blocks._gathered(iter(batches))]
    assert cut == [[0, 1], [2, 3], [4, 5, 6, 7], [8]]


def test_a_month_that_loses_its_terms_loses_its_postings(spark, tmp_path):
    path = str(tmp_path / "index")
    df = papers(spark)
    search.build_index(df, path)
    search.build_index(df.filter("ingest_year_month != '2024-02'"), path, ["2024-02"])
    query = search.one_query(spark, "neural networks data")
    rest = df.filter("ingest_year_month != '2024-02'")
    assert close(scores(search.search_index(spark, path, query, None)), scores(search.search(rest, query, k=None)))


def test_index_bounds_are_what_a_document_gains(spark, tmp_path, monkeypatch):
    """The most occurrences and the least length belong to different papers; a bound of both would be too high."""
    papers = spark.createDataFrame([
        ("a", "x", "graph", "2024-01"), ("b", "x", "graph graph graph " + "word " * 60, "2024-01"), ("c", "x", "data model", "2024-02"),
    ], "paper_id string, title string, abstract string, ingest_year_month string")
    seen, real = {}, search.top_documents

    def spy(found, weights, k):
        most = found.groupBy(*search.KEYS).agg(F.max("gain").alias("most"), F.count("*").alias("seen"))
        seen["rows"] = weights.join(most, search.KEYS).collect()
        return real(found, weights, k)

    monkeypatch.setattr(search, "top_documents", spy)
    search.build_index(papers, str(tmp_path / "i"), stem=False)
    queries = spark.createDataFrame([("q", "graph data")], "query_id string, text string")
    hits = search.search_index(spark, str(tmp_path / "i"), queries, stem=False).collect()
    assert {h.paper_id for h in hits} == {"a", "b", "c"}
    assert len(seen["rows"]) == 2 and all(r.top == r.most and r.df == r.seen for r in seen["rows"])


def test_each_word_is_stemmed_once(spark):
    """No join or filter on the term moves the stemmer to the occurrences."""
    docs = spark.createDataFrame(
        [("a", "Running runs relational", None), ("b", "runs runs", "ponies"), ("c", None, "")], "paper_id string, title string, abstract string"
    )
    analysed = search.analyse(docs, "paper_id", ["title", "abstract"])
    words = search.vocabulary(analysed, True)
    asked = spark.createDataFrame([("run",), ("poni",), ("none",), (None,)], "term string")
    met = words.join(asked, "term")
    assert "translate(" not in met._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.surface, r.term) for r in met.collect()) == [("ponies", "poni"), ("running", "run"), ("runs", "run")]
    assert sorted(r.surface for r in words.collect()) == ["ponies", "relational", "running", "runs"]
