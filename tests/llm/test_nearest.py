from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from corpuslens.llm import nearest

PRODUCTION = (12, 6, 1.5, 64)


def recall(vectors: np.ndarray, k: int = 20) -> float:
    """Share of the true k best that production parameters find; every query gets k rows, or all that there are."""
    ids = np.arange(len(vectors))
    asked = ids % 20 == 0
    found = nearest.search_slice(nearest.Tables(vectors.shape[1], *PRODUCTION), ids, vectors, ids[asked], vectors[asked], k)
    hits = total = 0
    for q in ids[asked]:
        score = vectors @ vectors[q]
        score[q] = -np.inf
        want = set(np.argsort(-score)[: min(k, len(ids) - 1)].tolist())
        got = found[1][found[0] == q].tolist()
        assert len(got) == len(set(got)) == len(want) and q not in got
        hits, total = hits + len(want & set(got)), total + len(want)
    return hits / total


@pytest.fixture(scope="module")
def given() -> np.ndarray:
    rows = pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet").sort_values("vec_id")
    return np.stack(rows["embedding"].to_numpy()).astype(np.float64)


@pytest.mark.parametrize("n", [2, 15, 20, 21])
def test_small_tables_give_all_candidates(given, n):
    assert recall(given[:n]) == 1


@pytest.mark.parametrize("by", [1, 10, 100])
def test_one_long_vector_does_not_hide_the_others(given, by):
    vectors = given.copy()
    vectors[7] *= by
    assert recall(vectors) >= 0.94


def test_unequal_norms(given):
    norms = np.random.default_rng(1).lognormal(0, 0.5, (len(given), 1))
    assert recall(given * norms) >= 0.9


def test_few_rows_through_spark(spark, given):
    rows = [(i, v.tolist()) for i, v in enumerate(given[:15])]
    df = nearest.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert nearest.nearest(df, df.filter("id = 0")).count() == 14
