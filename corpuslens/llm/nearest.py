"""Approximate nearest neighbours by largest inner product: multiprobe p-stable hashing with exact reranking."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.common import table


class Tables:
    """`tables` hash tables of `size` Gaussian projections each, in cells of `width`.

    Vectors get one more component that lifts all to the length `longest`, so that the nearest in the plain
    distance have the largest inner product. A query probes `probes` cells of each table in the order of their estimated
    success: the sum of squared distances to the sides that lie between.
    """

    def __init__(self, dimension: int, tables: int, size: int, width: float, probes: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.width, self.probes = width, probes
        self.lines = rng.standard_normal((tables, dimension + 1, size))
        self.shift = rng.uniform(0, width, (tables, 1, size))
        self.moves = np.array(list(itertools.product((-1, 0, 1), repeat=size)), np.int64)
        self.code = rng.integers(1, 1 << 62, size, dtype=np.int64)

    def _cells(self, points: np.ndarray) -> np.ndarray:
        return (points @ self.lines + self.shift) / self.width  # tables x points x size

    def _code(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells * self.code).sum(axis=-1)

    def buckets(self, vectors: np.ndarray, longest: float) -> np.ndarray:
        short = vectors / longest
        lift = np.sqrt(np.maximum(0, 1 - (short**2).sum(axis=1, keepdims=True)))
        return self._code(np.floor(self._cells(np.hstack([short, lift]))).astype(np.int64))

    def probed(self, queries: np.ndarray, probes: int | None = None) -> np.ndarray:
        """Buckets by table, query and order of success, the first `probes` of them."""
        unit = queries / np.sqrt((queries**2).sum(axis=1, keepdims=True))
        at = self._cells(np.hstack([unit, np.zeros((len(unit), 1))]))
        cell = np.floor(at)
        inside = at - cell
        down, up = inside**2 @ (self.moves == -1).T, (1 - inside) ** 2 @ (self.moves == 1).T
        best = np.argsort(down + up, axis=-1, kind="stable")[..., : probes or self.probes]
        return self._code(cell.astype(np.int64)[..., None, :] + self.moves[best])


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.float64)


def norm_ranges(vectors: np.ndarray, ratio: float = 1.25) -> list[tuple[np.ndarray, float]]:
    """Rows whose lengths are within `ratio`, with the longest length of each range. A range is hashed and lifted alone, so
    that a long vector doesn't move the others to one point."""
    length = np.sqrt((vectors**2).sum(axis=1))
    level = np.floor(np.log(length.max() / length) / np.log(ratio))
    return [(rows, float(length[rows].max())) for rows in (np.nonzero(level == x)[0] for x in np.unique(level))]


def search_slice(
    hashing: Tables, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, block: int = 64,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best candidates of each query among `vectors`: query, id, inner product. Ties go to smaller ids.

    Each norm range gives at least k candidates, or all its rows if it has no more: where the first probes reach
    fewer, probing goes on in the same order, and takes all rows when the cells are used up.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    ranges = [
        (rows, [np.unique(b, return_inverse=True) for b in hashing.buckets(vectors[rows], longest)] if len(rows) > k else None)
        for rows, longest in (norm_ranges(vectors) if len(ids) else [])
    ]
    cells = len(hashing.moves)

    def reached(tables: list, probes: np.ndarray, n: int) -> np.ndarray:
        """Rows of a range, by query, in the probed buckets."""
        seen = np.zeros((probes.shape[1], n), bool)
        for (known, member), probe in zip(tables, probes, strict=True):
            place = np.minimum(np.searchsorted(known, probe), len(known) - 1)
            hit = np.zeros((len(probe), len(known)), bool)
            row, col = np.nonzero(known[place] == probe)
            hit[row, place[row, col]] = True
            seen |= hit[:, member]
        return seen

    out: list[tuple] = []
    for start in range(0, len(queries), block):
        q = queries[start : start + block]
        own_ids = query_ids[start : start + block]
        seen = np.zeros((len(q), len(ids)), bool)
        first = hashing.probed(q)
        for rows, tables in ranges:
            if tables is None:
                seen[:, rows] = True
                continue
            part = reached(tables, first, len(rows))
            other = ids[rows] != own_ids[:, None]
            done = hashing.probes
            while len(short := np.nonzero((part & other).sum(axis=1) < k)[0]):
                if done >= cells:
                    part[short] = True
                    break
                following = hashing.probed(q[short], min(cells, 2 * done))[..., done:]
                part[short] |= reached(tables, following, len(rows))
                done = min(cells, 2 * done)
            seen[:, rows] = part
        for i, query in enumerate(q):
            own = query_ids[start + i]
            near = np.nonzero(seen[i])[0]
            near = near[ids[near] != own]
            score = (vectors[near] * query).sum(axis=1)  # each row alone, so that equal vectors score the same
            if len(near) > k:
                least = np.partition(score, len(score) - k)[len(score) - k]
                keep = np.nonzero(score >= least)[0]
                near, score = near[keep], score[keep]
            top = np.argsort(-score, kind="stable")[:k]
            out.append((np.full(len(top), own), ids[near[top]], score[top]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def usable(vectors: DataFrame, key: str, values: str) -> DataFrame:
    """(id, v): rows with an id and a vector that is not null or zero and has finite components only."""
    return vectors.select(F.col(key).cast("long").alias("id"), F.col(values).alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull()
    ).filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, tables: int = 12, size: int = 6, width: float = 1.5, probes: int = 64,
    slice_rows: int = 8192, query_rows: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates with the largest inner product for each query, itself left out.

    Both inputs are (id, v) as `usable` gives them. The vectors are dealt by a hash of the id into slices, the queries into
    blocks; each pair of slice and block is one bounded task that indexes its slice, probes it and reranks the
    candidates of all tables exactly; the best of the slices meet at the end. A bucket of any size is so spread
    over all slices. Vectors of another length than the most common one (the longer, if as common) take no part. Repeated
    ids count as rows of their own, except that a query never finds its own id. Empty inputs give no rows.
    """
    shape = vectors.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    ).orderBy(F.desc("n"), F.desc("d")).first()
    result = "query_id long, vec_id long, score double"
    if shape is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    hashing = (shape["d"], tables, size, width, probes)
    vectors, queries = vectors.filter(F.size("v") == shape["d"]), queries.filter(F.size("v") == shape["d"])
    slices = max(1, -(-shape["n"] // slice_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    part = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = vectors.withColumn("s", part(slices, 1)).withColumn("b", every(blocks)).groupBy("s", "b")
    asked = queries.withColumn("b", part(blocks, 2)).withColumn("s", every(slices)).groupBy("s", "b")

    def search(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(wanted):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = search_slice(
            Tables(*hashing), rows["id"].to_numpy(), _matrix(rows["v"]), wanted["id"].to_numpy(), _matrix(wanted["v"]), k
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = index.cogroup(asked).applyInPandas(search, result)
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others."""
    vectors = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest(vectors, vectors.filter("id % 20 = 0"))
