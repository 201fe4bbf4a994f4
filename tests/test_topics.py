from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslens.operators import topics as tp
from corpuslens.operators.numbering import numbered
from corpuslens.plans import topic_model


def test_projection_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 6)) * [5, 3, 1, 1, 1, 1]
    df = spark.createDataFrame([(f"p{i}", [float(v) for v in r]) for i, r in enumerate(x)], "paper_id string, embedding array<double>")
    got = {r.paper_id: (r.umap_x, r.umap_y) for r in tp.project_2d(df).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    _, _, axes = np.linalg.svd(unit - unit.mean(0), full_matrices=False)
    for k in range(2):
        axis = axes[k] * np.sign(axes[k][np.abs(axes[k]).argmax()])
        want = unit @ axis
        assert np.allclose([got[f"p{i}"][k] for i in range(80)], want, atol=1e-6)


def test_encoder_equals_brute_force(spark):
    texts = ["graph learning graph", "neural graph data", "data data model", ""]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "paper_id string, text string")
    got = {r.paper_id: r.embedding for r in tp.encode_texts(df, dims=32).collect()}
    place = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 32
    df_count = Counter(i for t in texts for i in {place(w) for w in t.split()})
    for i, t in enumerate(texts):
        v = np.zeros(32)
        for w in t.split():
            v[place(w)] += math.log((len(texts) + 1) / (df_count[place(w)] + 1))
        norm = np.linalg.norm(v)
        assert np.allclose(got[str(i)], v / norm if norm else v, atol=1e-6)


def clusters_by_hand(points, eps, min_samples, min_size):
    """Topic of each point, and which are border points, from all pairs."""
    at = np.array([p[1:] for p in points], float)
    gap = ((at[:, None] - at[None]) ** 2).sum(-1)
    near = gap <= eps * eps
    core = near.sum(1) >= min_samples
    component = {}
    for i in np.flatnonzero(core):
        if i in component:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if j not in component:
                component[j] = i
                stack += list(np.flatnonzero(near[j] & core))
    border = {}
    for i in np.flatnonzero(~core):
        others = np.flatnonzero(near[i] & core)
        if len(others):
            border[i] = min(others, key=lambda j: (gap[i, j], tuple(at[j])))
    member = {**component, **{i: component[j] for i, j in border.items()}}
    size = Counter(member.values())
    least = {c: min(tuple(at[i]) for i in component if component[i] == c) for c in size}
    rank = {c: k for k, c in enumerate(sorted((c for c in size if size[c] >= min_size), key=lambda c: (-size[c], least[c])))}
    return {p[0]: rank.get(member.get(i), -1) for i, p in enumerate(points)}, {points[i][0] for i in border}


@pytest.mark.parametrize("dims", [1, 2, 3, 5])
def test_clusters_equal_all_pairs_even_with_a_crowded_place(spark, dims):
    rng = random.Random(dims)
    points = [(f"p{i}", *(rng.gauss(0, 0.5) for _ in range(dims))) for i in range(260)]
    points += [(f"q{i}", 5 + rng.random() * 3, *(5 + rng.random() * 0.1 for _ in range(dims - 1))) for i in range(80)]
    points += [(f"hot{i}", *[-3.0] * dims) for i in range(200)] + [("by", -3.2, *[-3.0] * (dims - 1))]
    names = [f"c{i}" for i in range(dims)]
    df = spark.createDataFrame(points, "paper_id string, " + ", ".join(f"{c} double" for c in names))
    eps = {1: 0.02, 2: 0.13, 3: 0.25, 5: 0.55}[dims]
    want, border = clusters_by_hand(points, eps, 6, 12)
    rows = {r.paper_id: r for r in tp.assign_topics(df, eps, 6, 12, dims=names).collect()}
    assert {k: r.topic_id for k, r in rows.items()} == want and len(set(want.values())) >= 3
    held = [p for p in border if want[p] >= 0]
    assert held and all(0.5 <= rows[p].probability < 1 for p in held)
    assert all(rows[p].probability == 1 for p in want if want[p] >= 0 and p not in border)


def test_dense_parts_that_touch_at_one_pair_of_points(spark):
    """Two lines whose ends are just within reach, and a third that is just out of it."""
    points = [(f"a{i}", i * 0.01, 0.0) for i in range(100)] + [(f"b{i}", 0.99 + 0.0999 + i * 0.01, 0.0) for i in range(100)]
    points += [(f"c{i}", 0.5 + i * 0.01, 0.1001) for i in range(50)] + [("none", None, 0.0), ("nan", float("nan"), 0.0)]
    df = spark.createDataFrame(points, "paper_id string, umap_x double, umap_y double")
    got = {r.paper_id: r.topic_id for r in tp.assign_topics(df, 0.1, 4, 5).collect()}
    want, _ = clusters_by_hand(points[:-2], 0.1, 4, 5)
    assert got == {**want, "none": -1, "nan": -1} and set(want.values()) == {0, 1}


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_numbers_are_consecutive_over_all_parts(spark, n):
    rng = random.Random(n)
    rows = [(rng.randrange(50), i) for i in range(n)]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = numbered(spark.createDataFrame(rows, "a int, b int").repartition(5), F.desc("a"), "b").collect()
    finally:
        spark.conf.set(key, "true")
    assert sorted((r.number, r.a, r.b) for r in got) == [(k, a, b) for k, (a, b) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))]


def test_long_chain_is_one_component(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(i + 1, i) for i in range(n)] + [(1000, 1001), (1001, 1000)]
    nodes = [(i,) for i in range(n + 1)] + [(1000,), (1001,), (5000,)]
    got = tp.connected(
        spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame(nodes, "id long")
    ).collect()
    assert {r.id: r.component for r in got} == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000, 5000: 5000}


def test_topic_words_and_merge(spark):
    texts = {"a": "graph graph node", "b": "graph node edge", "c": "cell gene gene", "d": "gene graph"}
    topics = {"a": 0, "b": 0, "c": 1, "d": 2}
    docs = spark.createDataFrame(list(texts.items()), "paper_id string, text string")
    assigned = spark.createDataFrame(list(topics.items()), "paper_id string, topic_id int")
    weights = tp.class_tfidf(tp.topic_word_counts(docs, assigned))
    got = {(r.topic_id, r.term): r.weight for r in weights.collect()}
    assert math.isclose(got[(0, "graph")], 3 / 6 * math.log(1 + 11 / 3 / 4))
    merged = {r.topic_id: r.merged_id for r in tp.reduce_topics(assigned, weights, 2).collect()}
    assert merged == {0: 0, 1: 1, 2: 1}
    final = tp.apply_reduction(assigned, tp.reduce_topics(assigned, weights, 2))
    assert {r.paper_id: r.topic_id for r in final.collect()} == {"a": 0, "b": 0, "c": 1, "d": 1}


def merged_by_hand(vectors, size, n):
    """Rounds of mutual merges over plain dictionaries."""
    vectors, size = {t: dict(v) for t, v in vectors.items()}, dict(size)
    to = {t: t for t in size}
    while len(size) > n:
        def cosine(a, b):
            shared = vectors[a].keys() & vectors[b].keys()
            length = [math.sqrt(sum(x * x for x in vectors[t].values())) for t in (a, b)]
            return round(sum(vectors[a][w] * vectors[b][w] for w in shared) / length[0] / length[1], 9) if shared else None
        near = {}
        for a in size:
            found = [(-c, b) for b in size if b != a and (c := cosine(a, b)) is not None]
            if found:
                near[a] = min(found)
        pairs = []
        for a, (c, b) in near.items():
            if a < b and near[b][1] == a:
                src, dst = (b, a) if size[a] >= size[b] else (a, b)
                pairs.append((c, dst, src))
        over = len(size) - n
        if not pairs:
            largest = min(size, key=lambda t: (-size[t], t))
            pairs = [(0, largest, t) for t in sorted(size, key=lambda t: (size[t], -t))[:over]]
        for _, dst, src in sorted(pairs)[:over]:
            to = {t: dst if g == src else g for t, g in to.items()}
            size[dst] += size.pop(src)
            for w, x in vectors.pop(src).items():
                vectors[dst][w] = vectors[dst].get(w, 0) + x
    return to


@pytest.mark.parametrize("n", [1, 3, 6])
def test_similar_topics_merge_in_rounds(spark, n):
    """Two small topics on the same matter merge with each other, not with the largest."""
    rng = random.Random(4)
    matters = [[f"m{m}w{i}" for i in range(6)] + ["common"] for m in range(4)] + [["alone1"], ["alone2"]]
    vectors, rows = {}, []
    for t in range(12):
        words = matters[t % 4] if t < 10 else matters[t - 6]
        vectors[t] = {w: rng.uniform(0.1, 1) for w in words}
        rows += [(f"p{t}_{i}", t) for i in range(rng.randint(1, 9))]
    size = Counter(t for _, t in rows)
    topics = spark.createDataFrame(rows + [("x", -1)], "paper_id string, topic_id int")
    weights = spark.createDataFrame([(t, w, 1, x) for t, v in vectors.items() for w, x in v.items()], "topic_id int, term string, tf long, weight double")
    got = {r.topic_id: r.merged_id for r in tp.reduce_topics(topics, weights, n).collect()}
    assert got == merged_by_hand(vectors, size, n) and len(set(got.values())) == n
    if n == 6:
        assert {frozenset(t % 4 for t in got if t < 10 and got[t] == g) for g in set(got.values()) if g < 10} == {frozenset([m]) for m in range(4)}


def test_model_encoder_and_whole_run(spark):
    def load():
        return lambda texts: np.array([[len(t) % 7 + 1.0, "graph" in t] for t in texts])

    rng = random.Random(2)
    rows = [
        (f"p{i}", " ".join(rng.choices(("graph node edge path" if i % 2 else "cell gene tissue drug").split(), k=30)))
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "paper_id string, abstract string")
    assert tp.encode_with_model(df.withColumnRenamed("abstract", "text"), load).count() == 120
    run = topic_model.fit(df, eps=0.2, min_samples=5, min_cluster_size=10, n_words=3, dims=64, n_topics=2)
    info = run.info.collect()
    named = {frozenset(r.keywords[:3]) <= frozenset("graph node edge path".split()) for r in info}
    assert len(info) == 2 and named == {True, False}
    labels = {r.topic_label for r in run.assignments.collect()}
    assert labels - {"outlier"} == {r.topic_label for r in info}
    quality = tp.cluster_quality(run.assignments).first()
    assert quality.papers == 120 and quality.topics == 2 and quality.noise_ratio < 0.2
    assert run.coordinates.filter(F.col("umap_x").isNull()).isEmpty()


def test_pairs_of_places_are_compiled_and_dealt_over_all_tasks(spark):
    """Few rows make many pairs: both sides of the join go to all tasks, and no distance is read off a lambda."""
    rng = random.Random(3)
    spots = spark.createDataFrame([([rng.random() for _ in range(5)], 1) for _ in range(60)], "at array<double>, n long").select(
        "at", "n", tp._cell(F.col("at"), 0.3).alias("cell"), tp._cell(F.col("at"), 0.3 / 5**0.5).alias("fine"))
    judged = tp._core_spots(spots, tp._around(spots.select("cell").distinct(), 5), 0.3, 3, 5)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in plan and "aggregate(" not in plan
    assert plan.count("REPARTITION_BY_NUM") >= 2
    rows = judged.collect()
    at = np.array([r.at for r in rows])
    near = (((at[:, None] - at[None]) ** 2).sum(-1) <= 0.09).sum(1) >= 3
    assert len(rows) == 60 and [r.core for r in rows] == [bool(n) for n in near]


def test_crowded_and_joined_cells_equal_brute_force(spark):
    """A hot cell, a bridge that only single points of two crowded cells make, and lone points, in three dimensions."""
    rng = random.Random(8)
    eps, rows = 0.1, []
    for x in (0.0, 0.145, 0.5):
        rows += [(x + rng.random() * 0.05, rng.random() * 0.05, rng.random() * 0.05) for _ in range(150)]
    rows += [(0.0499, 0.0, 0.05), (0.1451, 0.0, 0.05)] + [(rng.uniform(-1, 2), rng.random(), rng.random()) for _ in range(60)]
    points = [(f"p{i}", *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(points, "paper_id string, x double, y double, z double")
    got = {r.paper_id: r.topic_id for r in tp.assign_topics(df, eps, 5, 10, dims=("x", "y", "z")).collect()}
    at = np.array(rows)
    near = ((at[:, None] - at[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= 5
    label = np.arange(len(at))
    for _ in range(len(at)):
        fresh = np.array([label[near[i] & core].min() if core[i] else label[i] for i in range(len(at))])
        if (fresh == label).all():
            break
        label = fresh
    for i in np.flatnonzero(core):
        for j in np.flatnonzero(core):
            if (label == label[i]).sum() >= 10 and (label == label[j]).sum() >= 10:
                assert (got[f"p{i}"] == got[f"p{j}"]) == (label[i] == label[j])
