from __future__ import annotations

import pathlib
import random

import numpy as np
import pytest

from corpuslens.functions import fixed_values as fixed
from corpuslens.operators import citations, influence
from corpuslens.session import bucketed, shared_dir

EDGES = "citing_id string, cited_id string, source string"


def frames(spark, edges, papers):
    return (
        spark.createDataFrame([(a, b, "s2orc") for a, b in edges], EDGES),
        spark.createDataFrame(papers, "paper_id string, s2_paper_id string, title string, citation_count int"),
    )


@pytest.mark.parametrize("links_per_bucket", [2, 1_000_000])
def test_pagerank_equals_matrix_iteration(spark, links_per_bucket):
    rng = random.Random(4)
    n = 30
    links = {(rng.randrange(n), rng.randrange(n)) for _ in range(60)} | {(0, i) for i in range(1, n)}
    links = {(a, b) for a, b in links if a != b and a < 25}
    got = influence.pagerank(
        spark.createDataFrame([(str(i),) for i in range(n)], "id string"),
        spark.createDataFrame([(str(a), str(b)) for a, b in links], "src string, dst string"),
        iterations=6, links_per_bucket=links_per_bucket,
    ).collect()
    m, idle = np.zeros((n, n)), np.ones(n)
    for a, b in links:
        m[b, a] = 1 / sum(x == a for x, _ in links)
        idle[a] = 0
    rank = np.ones(n)
    for _ in range(6):
        rank = 0.15 + 0.85 * (m @ rank + (idle * rank).sum() / n)
    assert np.allclose([r.pagerank for r in sorted(got, key=lambda r: int(r.paper_id))], rank)
    assert np.isclose(rank.sum(), n)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("buckets_")]


def test_pagerank_keeps_only_the_last_ranks(spark):
    folder = pathlib.Path(shared_dir(spark).removeprefix("file:")) / "corpuslens"
    before = set(folder.glob("*"))
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    links = spark.createDataFrame([("a", "b")], "src string, dst string")
    got = influence.pagerank(nodes, links, iterations=3)
    assert [p.name.split("-")[0] for p in set(folder.glob("*")) - before] == ["ranks"]
    assert got.count() == 2


def test_pagerank_rounds_read_one_row_a_node(spark, monkeypatch):
    """Ids may repeat or be null and links may leave the nodes; a busy source has further rows of bounded length."""
    kept = []

    def noted(df, *keys):
        kept.append(df.select(*keys, "to").collect())
        return bucketed(df, *keys)

    monkeypatch.setattr(influence, "bucketed", noted)
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("a",)], "id string")
    links = [("a", "b"), ("a", "c"), ("a", "x"), ("b", "a"), ("x", "a"), (None, "a"), ("c", None)]
    frame = spark.createDataFrame(links, "src string, dst string")
    rank = dict.fromkeys(["a", "b", "c", None], 1.0)
    for _ in range(3):
        idle = rank[None] / 4
        rank = {
            "a": 0.15 + 0.85 * (rank["b"] + idle), "b": 0.15 + 0.85 * (rank["a"] / 3 + idle),
            "c": 0.15 + 0.85 * (rank["a"] / 3 + idle), None: 0.15 + 0.85 * idle,
        }
    for links_per_bucket, tables in ((5, 1), (1, 2)):
        kept.clear()
        got = influence.pagerank(nodes, frame, iterations=3, links_per_bucket=links_per_bucket).collect()
        assert {r.paper_id: round(r.pagerank, 9) for r in got} == {k: round(v, 9) for k, v in rank.items()}
        assert len(got) == len(kept[0]) == 4 and len(kept) == tables
        assert sum(len(r.to or []) for rows in kept for r in rows) == 3


def test_alternate_ids(spark):
    edges, papers = frames(
        spark, [("a", "b"), ("a", "s9"), ("c", "sa"), ("a", "sa"), ("x", "b"), ("a", "gone")],
        [("a", "sa", "A", 1), ("b", "s9", "B", 2), ("c", None, "C", 3)],
    )
    got = {(r.src, r.dst) for r in influence.resolve_edges(edges, papers).collect()}
    assert got == {("a", "b"), ("c", "a")}
    scores = influence.influence_scores(papers)
    asked = papers.filter("paper_id = 'a'").select("paper_id")
    near = citations.neighbourhood(asked, edges, papers, scores).collect()
    assert {(r.direction, r.paper_id, r.title) for r in near} == {
        ("cited_by", "c", "C"), ("cited_by", "a", "A"), ("references", "b", "B"), ("references", "a", "A"),
    }
    assert {r.paper_id for r in citations.neighbourhood(asked, edges, papers, scores, "cited_by").collect()} == {"a", "c"}
    with pytest.raises(ValueError):
        citations.neighbourhood(asked, edges, papers, scores, limit=0)
    with pytest.raises(ValueError):
        citations.neighbourhood(asked, edges, papers, scores, "sideways")


@pytest.mark.parametrize("counts", [[None, None], [3, 3], [0, 10, 1000], [None, 5]])
def test_scores_stay_in_range(spark, counts):
    papers = spark.createDataFrame([(str(i), c) for i, c in enumerate(counts)], "paper_id string, citation_count int")
    scores = [r.pagerank_score for r in influence.influence_scores(papers).orderBy("paper_id").collect()]
    assert min(scores) == fixed.SCORE_FLOOR and max(scores) <= 1.0
    known = [c or 0 for c in counts]
    if max(known) > min(known):
        assert scores[known.index(max(known))] == pytest.approx(1.0)
    else:
        assert set(scores) == {fixed.SCORE_FLOOR}


def test_no_papers(spark):
    papers = spark.createDataFrame([], "paper_id string, citation_count int")
    scores = influence.influence_scores(papers)
    assert scores.isEmpty()
    assert influence.score_summary(scores).first().total == 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [None, 2])
def test_neighbours_read_the_edges_once_a_direction(spark, tmp_path, limit):
    edges, papers = frames(
        spark, [("a", "b"), ("a", "sb"), ("a", "c"), ("c", "sb"), ("d", "b"), ("a", "d"), (None, "b"), ("a", None)],
        [("a", None, "A", 1), ("b", "sb", "B", 2), ("c", "", "C", 3), ("d", "sd", "D", 4), ("b", "sb", "B", 2)],
    )
    edges.write.parquet(f"{tmp_path}/edges")
    edges, scores = spark.read.parquet(f"{tmp_path}/edges"), influence.influence_scores(papers).distinct()
    asked = papers.select("paper_id").distinct()
    got = citations.neighbourhood(asked, edges, papers.distinct(), scores, limit=limit)
    assert plan_of(got).count("FileScan") == 2
    assert plan_of(citations.references(asked, edges, papers, scores, limit)).count("FileScan") == 1
    found = {}
    for r in got.collect():
        found.setdefault((r.request_id, r.direction), []).append(r.paper_id)
    first = slice(limit)
    assert {k: sorted(v, key=str) for k, v in found.items()} == {
        ("a", "references"): ["b", "c", "d"][first], ("c", "references"): ["b"], ("d", "references"): ["b"],
        ("b", "cited_by"): sorted([None, "a", "c", "d"][first], key=str), ("c", "cited_by"): ["a"], ("d", "cited_by"): ["a"],
    }
