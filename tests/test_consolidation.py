from __future__ import annotations

import gzip
import json
import uuid

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import consolidate
from corpuslens.operators import trends as tr
from corpuslens.plans import consolidation
from corpuslens.sources import normalise, readers, writers

A = [
    {"paper_id": "2401.00001", "title": "A one", "abstract": "aa", "authors": ["X"], "submitted_date": "2024-01-05",
     "primary_category": "cs.LG", "all_categories": ["cs.LG"], "ingested_at": "2024-02-02T00:00:00"},
    {"paper_id": "2401.00001", "title": "A one again", "abstract": None, "ingested_at": "2024-02-03T00:00:00",
     "submitted_date": "2024-01-06", "updated_date": "2024-03-01"},
    {"paper_id": "", "title": "no key", "ingested_at": "2024-02-02T00:00:00"},
]
B = [
    {"paper_id": "2401.00001", "s2_paper_id": "sha1", "title": "B one", "date": "2023", "citation_count": 7,
     "ingested_at": "2024-01-01T00:00:00"},
    {"paper_id": "77", "title": "B two", "date": "2024", "citation_count": 3, "categories": ["Physics"],
     "ingested_at": "2024-01-01T00:00:00"},
    {"paper_id": "78", "title": "B three", "date": "n.d.", "ingested_at": "2024-01-01T00:00:00"},
    {"citing_id": "77", "cited_id": "sha1", "ingested_at": "x"},
    {"citing_id": "77", "cited_id": "sha1", "ingested_at": "y"},
    {"citing_id": "77", "cited_id": None, "ingested_at": "y"},
    {"paper_id": "77", "full_text": "short", "sections": [{"heading": "h", "text": "t"}], "ingested_at": "2024-01-01T00:00:00"},
    {"paper_id": "77", "full_text": "a longer body", "ingested_at": "2024-01-01T00:00:00"},
    {"paper_id": "79", "full_text": "", "ingested_at": "2024-01-01T00:00:00"},
]
C = [
    {"paper_id": "2401.00001", "title": "C one", "cited_by_count": 9, "publication_date": "2024-01-02",
     "authors": [{"name": "Y", "orcid": "o"}], "concepts": [{"name": "ML", "score": 0.9}], "ingested_at": "2024-03-01T00:00:00"},
    {"paper_id": "90", "title": "C two", "cited_by_count": 1, "publication_date": "2022-05-05",
     "authors": [{"name": "Z"}], "concepts": [{"name": "Art", "score": 0.1}], "ingested_at": "2024-03-01T00:00:00"},
]


def land(tmp_path, source, category, records):
    folder = tmp_path / source / category / "2024-06-30"
    folder.mkdir(parents=True)
    lines = [json.dumps(r) for r in records]
    (folder / "batch.jsonl").write_text("\n".join([*lines, '{"paper_id": "torn'][: len(lines) + (source == "arxiv")]))


@pytest.fixture
def landing(tmp_path):
    land(tmp_path, "arxiv", "cs.LG", A)
    land(tmp_path, "s2orc", "bulk", B)
    land(tmp_path, "openalex", "general", C)
    land(tmp_path, "ner", "2024-06-30", [{"paper_id": "77", "methods": ["bert"], "datasets": [], "tasks": None}])
    land(tmp_path, "bertopic", "spark_merge", [
        {"paper_id": "77", "topic_cluster_id": 1, "topic_cluster": "graphs", "umap_x": 0.5, "umap_y": 1.5},
        {"paper_id": "78", "topic_cluster": "no id"},
    ])
    return str(tmp_path)


def test_whole_run(spark, landing, tmp_path):
    db = f"run_{uuid.uuid4().hex}"
    writers.create_tables(spark, db, str(tmp_path / "tables"))
    consolidation.run(spark, landing, db)
    papers = {r.paper_id: r for r in spark.table(f"{db}.papers").collect()}
    assert set(papers) == {"2401.00001", "77", "78", "90"}
    one = papers["2401.00001"]
    assert (one.title, one.abstract, one.authors, one.source) == ("A one", "aa", ["X"], "arxiv")
    assert (one.citation_count, one.s2_paper_id, str(one.submitted_date)) == (9, "sha1", "2024-01-05")
    assert str(one.updated_date) == "2024-03-01" and str(one.ingested_at) == "2024-01-01 00:00:00"
    assert one.ingest_year_month == "2024-01"
    assert (papers["90"].authors, papers["90"].categories) == (["Z"], ["Art"])
    assert papers["78"].submitted_date is None and papers["78"].ingest_year_month == "unknown"
    assert str(papers["77"].submitted_date) == "2024-01-01"
    assert (papers["77"].methods, papers["77"].topic_cluster, papers["77"].umap_y) == (["bert"], "graphs", 1.5)
    assert papers["78"].topic_cluster_id is None
    assert [tuple(r) for r in spark.table(f"{db}.citation_edges").collect()] == [("77", "sha1", "s2orc")]
    body = spark.table(f"{db}.paper_fulltext").collect()
    assert [(r.paper_id, r.full_text, r.arxiv_id, r.corpusid) for r in body] == [("77", "a longer body", None, "77")]
    assert spark.table(f"{db}.pagerank_scores").count() == 4
    trends = spark.table(f"{db}.trends").collect()
    assert sum(r.paper_count for r in trends if r.grain == "category") == 3
    assert [(r.topic_cluster, r.year_month, r.paper_count) for r in trends if r.grain == "topic"] == [("graphs", "2024-01", 1)]
    # A second run leaves the same tables.
    consolidation.run(spark, landing, db)
    assert spark.table(f"{db}.papers").count() == 4 and spark.table(f"{db}.trends").count() == len(trends)


def unified(spark, seed):
    rows = [
        (f"p{i % 15}", f"t{i}" if i % 4 else None, i % 7 if i % 3 else None, ["arxiv", "s2orc", "openalex", "other"][i % 4],
         f"2024-01-{1 + i % 5:02d}")
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "paper_id string, title string, citation_count int, source string, ingested_at string")
    return df.orderBy(F.rand(seed)).repartition(1 + seed % 5)


def test_merge_does_not_depend_on_order_or_partitions(spark):
    def merged(seed):
        df = readers.unify(unified(spark, seed), "x").drop("source").join(
            unified(spark, seed).select("paper_id", "title", "citation_count", "ingested_at", "source"),
            ["paper_id", "title", "citation_count", "ingested_at"], "left",
        )
        return {tuple(r[:]) for r in consolidate.merge_sources(df).select(
            "paper_id", "title", "citation_count", "source", "ingested_at").collect()}

    assert merged(1) == merged(2) == merged(13)


def test_landing_paths_skip_other_kinds_and_days(spark, tmp_path):
    for category, day in (("cs.LG", "2024-01-01"), ("cs.LG", "2024-01-09"), ("edges", "2024-01-01"), ("cs.AI", "2023-12-31")):
        (tmp_path / "s2orc" / category / day).mkdir(parents=True)
    found = readers.landing_paths(spark, str(tmp_path), "s2orc", "2024-01-01", "2024-01-05")
    assert [p.split("/s2orc/")[1] for p in found] == ["cs.LG/2024-01-01"]
    assert len(readers.landing_paths(spark, str(tmp_path), "s2orc")) == 3


def test_shard_cap(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text("\n".join('{"a": %d}' % i for i in range(9)) + "\n{broken")
    path = str(tmp_path / "s.jsonl")
    assert readers.read_shard(spark, path, "a int", 4).count() == 4
    assert readers.read_shard(spark, path, "a int").count() == 9
    report = readers.malformed_report(spark, path, "a int").first()
    assert (report.good_lines, report.bad_lines) == (9, 1)


def test_writing_no_documents(spark, tmp_path):
    df = spark.createDataFrame([], "paper_id string")
    assert writers.write_docs(df, str(tmp_path / "d")) == {"total_read": 0, "total_written": 0}


def test_vectors_of_changed_texts_are_encoded_again(spark, tmp_path):
    def texts(*pairs):
        return spark.createDataFrame(list(pairs), "paper_id string, text string")

    def encode(value):
        return lambda df: df.withColumn("embedding", F.array(F.lit(float(value)), F.lit(0.0)))

    path = str(tmp_path / "v")
    writers.embedding_store(texts(("a", "x"), ("b", "y")), path, "m", 2, encode(1))
    got = writers.embedding_store(texts(("a", "x"), ("b", "changed"), ("c", "z")), path, "m", 2, encode(2))
    assert {r.paper_id: r.embedding[0] for r in got.collect()} == {"a": 1.0, "b": 2.0, "c": 2.0}
    other = writers.embedding_store(texts(("a", "x")), path, "n", 2, encode(3))
    assert other.first().embedding[0] == 3.0


def test_edge_direction(spark):
    rows = [
        ({"ArXiv": "2401.00001v2"}, None, "p", [("x", None), (None, "5"), ("2401.00001", None)], [("y", None)]),
        ({}, "9", "p", [("9", None)], [("y", None), ("9", None)]),
        ({}, None, None, [("x", None)], None),
    ]
    raw = spark.createDataFrame(
        rows, "externalIds map<string,string>, corpusId string, paperId string, "
        "references array<struct<paperId: string, corpusId: string>>, citations array<struct<paperId: string, corpusId: string>>",
    )
    got = {(r.citing_id, r.cited_id) for r in normalise.extract_edges(raw, F.lit("now")).collect()}
    assert got == {("2401.00001", "x"), ("2401.00001", "5"), ("y", "9")}


def test_bulk_records(spark):
    text = "Title here. Ann Lee Bob Intro body one Results body two"

    def span(word, number=False):
        i = text.index(word)
        return {"start": i if number else str(i), "end": i + len(word) if number else str(i + len(word))}

    notes = {
        "title": json.dumps([span("Title here.", True)]),
        "abstract": json.dumps([span("body one"), {"start": 5, "end": 9999}, {"start": "x", "end": 2}]),
        "authorfirstname": json.dumps([span("Bob"), span("Ann")]), "authorlastname": json.dumps([span("Lee")]),
        "sectionheader": json.dumps([span("Results"), span("Intro")]), "paragraph": "not json",
    }
    raw = spark.createDataFrame(
        [(5, {"arXiv": "2401.5v1", "DOI": ""}, (text, notes), "2020")],
        "corpusid bigint, externalids map<string,string>, content struct<text: string, annotations: map<string,string>>, year string",
    ).selectExpr("*", "cast(null as string) publicationdate", "cast(null as string) venue",
                 "cast(null as array<string>) fieldsofstudy", "4 as citationcount", "cast(null as int) referencecount")
    row = normalise.normalise_b(normalise.reshape_bulk(raw), F.lit("now")).first()
    assert (row.paper_id, row.title, row.abstract, row.authors) == ("2401.5", "Title here.", "body one", ["Ann Lee", "Bob"])
    assert [tuple(s) for s in row.sections] == [("Intro", "body one"), ("Results", "body two")]
    assert (row.date, row.citation_count, row.reference_count, row.is_open_access, row.doi) == ("2020", 4, 0, True, "")


def test_signals_need_two_months_and_shrink_their_window(spark):
    counts = {"one": [5], "two": [4, 8], "three": [10, 4, 2], "six": [1, 1, 1, 2, 2, 2], "flat": [3, 3, 3, 3]}
    rows = [(t, f"2024-{m:02d}", c) for t, series in counts.items() for m, c in enumerate(series, 1)]
    got = {r.topic_cluster: r for r in tr.trend_signals(
        spark.createDataFrame(rows, "topic_cluster string, year_month string, paper_count long")).collect()}
    assert set(got) == {"two", "three", "six", "flat"}
    assert (got["two"].signal, got["two"].growth_rate) == ("emerging", 1.0)
    assert (got["three"].signal, got["three"].growth_rate) == ("declining", -0.5)
    assert (got["six"].signal, got["six"].growth_pct, got["six"].recent_avg_papers) == ("emerging", 100.0, 2.0)
    assert got["flat"].signal == "stable"


def test_skipped_days_are_never_opened(spark, tmp_path):
    for category in ("cs", "edges"):
        for day in ("2024-01-01", "2024-01-02", "2024-01-03", "other"):
            folder = tmp_path / "s2orc" / category / day
            folder.mkdir(parents=True)
            wanted = category == "cs" and day in ("2024-01-02", "2024-01-03")
            # What isn't wanted is no gzip file, and would stop whatever opens it.
            (folder / "part.json.gz").write_bytes(gzip.compress(f'{{"k": "{category} {day}"}}\n'.encode()) if wanted else b"none")
    df = readers.read_day_folders(spark, str(tmp_path), "k string", "s2orc", "2024-01-02")
    assert sorted((r.k, str(r.day), r.category) for r in df.collect()) == [
        (f"cs 2024-01-0{d}", f"2024-01-0{d}", "cs") for d in (2, 3)
    ]
    assert [r.k for r in df.filter("day = date '2024-01-03'").collect()] == ["cs 2024-01-03"]
    assert readers.read_day_folders(spark, str(tmp_path), "k string", "arxiv").count() == 0
