"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text is judged passage by passage: blocks of 2,000 characters follow each other, every two neighbours are a window, and the
worst window is the text's. So a toxic part is found however much clean text stands around it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import fold, table
from corpuslens.session import cut_lineage

#: Hashed n-grams. The model is two arrays of this length at every size of the corpus.
FEATURES = 1 << 20
SIZES = (3, 4, 5, 6, 7)
#: Characters of a block; a window is two neighbours.
BLOCK = 2000
FOLDS = 5


class Grams:
    """Distinct hashed character n-grams of each block of a text, white space folded and case dropped."""

    def __init__(self, block: int = BLOCK):
        self.block, self.place = block, np.zeros(FEATURES, np.int32)

    def _hashed(self, chars: np.ndarray) -> Iterator[np.ndarray]:
        value = np.zeros(len(chars), np.uint64)
        with np.errstate(over="ignore"):
            for n in range(1, max(SIZES) + 1):
                if len(chars) < n:
                    return
                value = value[: len(chars) - n + 1] * np.uint64(1000003) + chars[n - 1 :]
                if n in SIZES:
                    yield ((value ^ (value >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(44)

    def of(self, text: str | None) -> Iterator[np.ndarray]:
        """One array a block; n-grams over the edge of a block count in the first."""
        text = " " + " ".join((text or "").lower().split()) + " "
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        for start in range(0, len(chars), self.block):
            ids = np.concatenate([*self._hashed(chars[start : start + self.block + max(SIZES) - 1]), np.zeros(0, np.uint64)]).astype(np.int32)
            order = np.arange(len(ids), dtype=np.int32)
            self.place[ids] = order
            yield ids[self.place[ids] == order]  # one of each


def windows(blocks: list) -> list:
    """Sums of neighbours, or the only block."""
    return [a + b for a, b in pairwise(blocks)] or blocks


def labelled_sample(documents: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, text, toxic) of about `per_class` learning documents of each class, or of all if there are fewer. A hash of
    the id decides, row by row, so no task and not the driver ever ranks all labels.

    Rows of `labels` with a null are no labels; an id labelled both ways is toxic. Of rows with the same id one is taken.
    """
    known = labels.filter("doc_id is not null and toxic is not null").filter(fold(F.col("doc_id"), FOLDS) != 0).groupBy(
        "doc_id"
    ).agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    share = [int((1 << 20) * min(1.0, per_class / sizes.get(k, 1))) for k in (0, 1)]
    ids = cut_lineage(known.filter(F.col("toxic").isin(0, 1) & (draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))))
    return documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")
    )


def fit_logistic(
    rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, ridge: float, steps: int, share: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Weights of the scaled features and the intercept, by accelerated gradient descent with equal class weights.

    A row lists its features, as often as they count; `share` is what a row counts inside its class.
    """
    used, inverse = np.unique(np.concatenate([*rows, np.zeros(0, np.int32)]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    scale = ratio[used]
    share = np.ones(len(rows)) if share is None else share
    weight = share * np.where(y == 1, 0.5 / max(1e-9, share[y == 1].sum()), 0.5 / max(1e-9, share[y != 1].sum()))
    # Each weight has a step of its own, from a diagonal that bounds the curvature.
    reach = np.bincount(owner, np.abs(scale[inverse]), len(rows)) + 1
    bend = np.append(np.bincount(inverse, (weight * reach)[owner], len(used)) * np.abs(scale), (weight * reach).sum())
    rate = 1 / (0.25 * bend + ridge)
    w = np.zeros(len(used) + 1)
    ahead, momentum = w.copy(), 1.0
    for _ in range(steps):
        z = np.bincount(owner, (ahead[:-1] * scale)[inverse], len(rows)) + ahead[-1]
        error = weight * (1 / (1 + np.exp(-z)) - y)
        slope = np.append(np.bincount(inverse, error[owner], len(used)) * scale + ridge * ahead[:-1], error.sum())
        fresh, next_ = ahead - rate * slope, (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, w, momentum = fresh + (momentum - 1) / next_ * (fresh - w), fresh, next_
    out = np.zeros(FEATURES, np.float32)
    out[used] = w[:-1] * scale
    return out, float(w[-1])


def train(
    documents: DataFrame, labels: DataFrame, per_class: int = 6000, per_document: int = 4, least_ratio: float = 1.5, ridge: float = 1e-2,
    steps: int = 80,
) -> tuple[np.ndarray, float]:
    """Weight of each hashed n-gram, and the intercept.

    The classifier is fitted on a sample of about `per_class` labelled documents of each class and of up to `per_document`
    windows of each, evenly spread over it (fixed bounds). Counts of windows per n-gram and class are summed in Spark and give
    the log-count ratios, of both signs; what leans to neither class, by a ratio under `least_ratio`, would be scaled to
    little and is left out. A document's windows share its weight. One task fits the bounded rest. Without both classes
    every score is 0.5 and below.
    """
    sample = cut_lineage(labelled_sample(documents, labels, per_class))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return np.zeros(FEATURES, np.float32), 0.0 if sizes.get(1) else -1.0

    def chosen(grams: Grams, text: str | None) -> list[np.ndarray]:
        blocks = list(grams.of(text))
        pairs = [np.concatenate(p) for p in pairwise(blocks)] or blocks
        return [pairs[i * len(pairs) // per_document] for i in range(per_document)] if len(pairs) > per_document else pairs

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, sums = Grams(), np.zeros((2, FEATURES), np.float64)
        for b in batches:
            for text, toxic in zip(b["text"], b["toxic"], strict=True):
                parts = chosen(grams, text)
                for ids in parts:
                    sums[toxic][np.unique(ids)] += 1 / len(parts)
        i = np.nonzero(sums.any(axis=0))[0]
        yield pd.DataFrame({"i": i, "clean": sums[0][i], "toxic": sums[1][i]})

    leaning = F.log((F.sum("toxic") + 1) / (sizes[1] + 2) / ((F.sum("clean") + 1) / (sizes[0] + 2)))
    counted = sample.mapInPandas(count, "i int, clean double, toxic double").groupBy("i").agg(
        leaning.alias("ratio"), F.sum(F.col("clean") + F.col("toxic")).alias("n")
    ).filter((F.abs("ratio") >= least_ratio) & (F.col("n") >= 2)).select("i", "ratio").collect()  # FEATURES rows at most
    ratio = np.zeros(FEATURES, np.float32)
    for r in counted:
        ratio[r["i"]] = r["ratio"]
    shared = sample.sparkSession.sparkContext.broadcast(ratio)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, ratio = Grams(), shared.value
        for b in batches:
            rows = [
                (d, x, ids[ratio[ids] != 0], 1 / len(parts))
                for d, x, t in zip(b["doc_id"], b["toxic"], b["text"], strict=True) for parts in [chosen(grams, t)] for ids in parts
            ]
            yield pd.DataFrame(rows, columns=["doc_id", "toxic", "ids", "share"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id", kind="stable")
        w, b = fit_logistic(
            list(group["ids"]), group["toxic"].to_numpy(np.float64), shared.value.astype(float), ridge, steps, group["share"].to_numpy()
        )
        i = np.nonzero(w)[0]
        return pd.DataFrame({"i": np.append(i, -1), "w": np.append(w[i], b)})

    bounded = sample.mapInPandas(features, "doc_id long, toxic int, ids array<int>, share double").withColumn("all", F.lit(0))
    model = bounded.groupBy("all").applyInPandas(
        fit, "i int, w double"
    ).collect()  # as many rows as n-grams have a ratio, and the intercept
    weights = np.zeros(FEATURES, np.float32)
    for r in model:
        if r["i"] >= 0:
            weights[r["i"]] = r["w"]
    return weights, next(r["w"] for r in model if r["i"] < 0)


def score(documents: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """`documents` with `score`, from 0 to 1, and `predicted`, 1 from a score of 0.5.

    Every whole text is scored on its own, in batches, by the worst of its windows; a null text counts as empty. Ids, repeated
    rows and other columns have no influence; own columns of the same names are replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        (weights, intercept), grams = shared.value, Grams()
        for batch in texts:
            z = np.array([max(windows([weights[ids].sum(dtype=np.float64) for ids in grams.of(t)])) for t in batch]) + intercept
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -700, 700))))

    return documents.withColumn("score", scored("text")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows that are not predicted toxic, whole; columns of any name stay as they are. Null and empty texts are judged as the
    empty text, repeated rows and ties alike, long texts by all their windows; an empty table gives none."""
    judged = score(documents.withColumn("_row", F.struct(*documents.columns)), train(documents, labels))
    return judged.filter("predicted = 0").select("_row.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned from the labels of four folds out of five. Nulls, empty and long texts, ties, repeated
    rows, empty tables and clashing names as in `score` and `labelled_sample`."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score", "predicted")
