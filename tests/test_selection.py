from __future__ import annotations

import math
import random
from datetime import date

from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.operators import selection as sel

SCHEMA = (
    "query_id string, paper_id string, topic_cluster_id int, citation_count int, "
    "relevance double, influence double, recency double, representativeness double"
)


def random_rows(seed: int, queries: int = 20, papers: int = 40):
    rng = random.Random(seed)
    return [
        (
            f"q{q}", f"p{p:03d}", rng.choice([-1, 0, 1, 2, 3]), rng.choice([None, 0, 5, 50000]),
            *[rng.choice([0.0, 0.25, 0.5, 1.0, rng.random()]) for _ in range(4)],
        )
        for q in range(queries) for p in range(papers)
    ]


def greedy(rows, n, weights):
    """Pick by pick: the best composite score given the topics already chosen."""
    left = sorted(rows, key=lambda r: r[1])
    seen: dict[int, int] = {}
    out = []
    while left and len(out) < n:
        def composite(r):
            base = round(sum(weights[s] * r[4 + i] for i, s in enumerate(list(weights)[:4])), 9)
            div = 0.0 if r[2] == -1 else 1 / (1 + seen.get(r[2], 0))
            return round(base + weights["diversity"] * div, 9)

        best = max(left, key=lambda r: (composite(r), [-ord(c) for c in r[1]]))
        out.append(best[1])
        left.remove(best)
        seen[best[2]] = seen.get(best[2], 0) + 1
    return out


def test_closed_form_equals_greedy_choice(spark):
    rows = random_rows(1)
    got = sel.select_diverse(spark.createDataFrame(rows, SCHEMA), 12).orderBy("query_id", "rank").collect()
    for q in {r[0] for r in rows}:
        want = greedy([r for r in rows if r[0] == q], 12, dict(fixed.SIGNAL_WEIGHTS))
        assert [g.paper_id for g in got if g.query_id == q] == want


def sequential(rows):
    taken, out = set(), {}
    for r in rows:
        topic = r["topic_cluster_id"]
        points = {
            "foundational": 0.7 * r["influence"] + 0.3 * min(1.0, math.log1p(r["citation_count"] or 0) / 10),
            "representative": r["representativeness"],
            "emerging": 0.7 * r["recency"] + 0.3 * r["relevance"],
            "contrasting": 1.0 if topic != -1 and topic not in taken else 0.0,
        }
        name = max(points, key=points.get)
        out[r["paper_id"]] = name if points[name] > 0.5 else None
        if out[r["paper_id"]] and topic != -1:
            taken.add(topic)
    return out


def test_categories_equal_sequential_rule(spark):
    chosen = sel.select_diverse(spark.createDataFrame(random_rows(2), SCHEMA), 20)
    got = sel.assign_categories(chosen).collect()
    for q in {r.query_id for r in got}:
        rows = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert {r.paper_id: r.category for r in rows} == sequential(rows)


def test_partial_weights_keep_defaults():
    w = sel.full_weights({"recency": 0.65})
    assert math.isclose(sum(w.values()), 1.0)
    assert math.isclose(w["relevance"] / w["diversity"], 3.5)
    assert math.isclose(w["recency"], 0.65 / 1.5)


def candidate(spark, rows):
    schema = (
        "query_id string, paper_id string, es_score double, pagerank_score double, umap_x double, umap_y double, "
        "topic_cluster_id int, submitted_date date"
    )
    return spark.createDataFrame(rows, schema)


def test_signals(spark):
    day = date(2024, 1, 1)
    rows = [
        ("q", "a", 2.0, 1.0, 0.0, 0.0, 1, date(2025, 1, 1)),
        ("q", "b", 4.0, None, 4.0, 0.0, 1, date(2023, 1, 1)),
        ("q", "c", 0.0, 0.15, 3.0, 0.0, 1, None),
        ("q", "d", 1.0, 0.575, 9.0, 9.0, -1, day),
        ("q", "e", 1.0, 0.575, None, 9.0, 2, day),
    ]
    got = {
        r.paper_id: r
        for r in sel.score_signals(candidate(spark, rows), F.lit("2024-01-01").cast("date")).collect()
    }
    assert [got[p].relevance for p in "abc"] == [0.5, 1.0, 0.0]
    assert got["a"].influence == 1.0 and got["b"].influence == 0.0 and math.isclose(got["d"].influence, 0.5)
    assert got["a"].recency == 1.0 and got["c"].recency == 0.0 and math.isclose(got["b"].recency, math.exp(-1))
    # Outliers and papers without a place are never representative.
    assert got["d"].representativeness == 0.0 and got["e"].representativeness == 0.0
    assert got["c"].representativeness == 1.0 and got["a"].representativeness == 0.0


def test_equal_scores_and_no_topic(spark):
    rows = [("q", p, 0.0, 0.15, None, None, None, None) for p in "ab"]
    scored = sel.score_signals(candidate(spark, rows), F.lit("2024-01-01").cast("date"))
    got = sel.select_diverse(scored, 5).collect()
    assert [(r.paper_id, r.composite_score) for r in sorted(got, key=lambda r: r["rank"])] == [("a", 0.0), ("b", 0.0)]


def test_model_classifier(spark):
    def load_model():
        return lambda texts: [("LIMITATION" if "limit" in t else "OTHER", 0.9) for t in texts]

    sentences = spark.createDataFrame([("p", 0, "a limit"), ("p", 1, "none")], "paper_id string, pos int, sentence string")
    top = sel.top_sentences(sel.classify_with_model(sentences, load_model))
    assert sel.annotations(top).first().asDict() == {
        "paper_id": "p", "methodological_details": [], "limitations": ["a limit"], "contributions": [],
        "evaluation_context": [],
    }


def test_default_cues(spark):
    rows = [(0, "However, we evaluate it."), (1, "We propose a novel thing."), (2, "Plain.")]
    got = sel.classify_with_cues(spark.createDataFrame(rows, "pos int, sentence string")).orderBy("pos").collect()
    assert [(r.label, r.confidence) for r in got] == [("EVALUATION", 0.95), ("METHODOLOGY", 0.9), ("OTHER", 0.0)]
