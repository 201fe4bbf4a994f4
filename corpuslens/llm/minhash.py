"""Near copies by the similarity of their word shingles: candidates by MinHash bands, each link verified exactly.

A pair of similarity 0.8 meets in at least one of 28 bands of 5 hashes with probability 1 - 2e-5. No link rests on the
bands alone: the shingle sets of both texts are compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.components import connected
from corpuslens.session import cut_lineage

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 28, 5
_rng = np.random.default_rng(11)
FACTORS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FLIPS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles_of(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `width` lower-cased words; a shorter text is one run, a wordless one 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(1, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashed = np.fromiter((digest(w, 42) for w in words), np.uint64, len(words))
    width = min(width, len(words))
    n = len(words) - width + 1
    value = np.full(n, width, np.uint64)
    for j in range(width):
        value = value * np.uint64(0x9E3779B97F4A7C15) + hashed[j : j + n]
        value ^= value >> np.uint64(31)
    return np.unique(value * np.uint64(0xBF58476D1CE4E5B9))


def bands_of(shingles: np.ndarray, block: int = 1024) -> np.ndarray:
    """One value for each band, from the least hashes of its rows."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for start in range(0, len(shingles), block):
        part = shingles[start : start + block]
        np.minimum(least, ((part ^ FLIPS[:, None]) * FACTORS[:, None]).min(axis=1), out=least)
    value = np.zeros(BANDS, np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        value = (value ^ row) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of sorted distinct hashes."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _sketches(documents: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, key, n, bands) of every row; `key` and `n` tell its set of shingles and the set's size."""

    @F.pandas_udf("key long, n int, bands array<long>")
    def sketch(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for x in batch:
                s = shingles_of(x, width)
                key = int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), 42)).view(np.int64))
                rows.append((key, len(s), bands_of(s)))
            yield pd.DataFrame(rows, columns=["key", "n", "bands"])

    return documents.select("doc_id", F.xxhash64("text").alias("text_key"), sketch("text").alias("s")).select("doc_id", "text_key", "s.*")


def _sets(documents: DataFrame, needed: DataFrame, width: int) -> DataFrame:
    """(key, s): the sorted shingles of one text of each set in `needed(key, text_key)`."""

    @F.pandas_udf("array<long>")
    def shingles(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles_of(x, width).view(np.int64) for x in texts])

    texts = documents.select(F.xxhash64("text").alias("text_key"), "text")
    return texts.join(needed, "text_key").groupBy("key").agg(F.first("text").alias("text")).select("key", shingles("text").alias("s"))


def _ranked(sets: DataFrame) -> DataFrame:
    """(key, n, alone, rare) of each set: how many of its shingles no other set has, and those that others share, from the
    rarest."""
    rows = sets.select("key", F.explode("s").alias("h"))
    shared = rows.groupBy("h").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    order = F.array_sort(F.collect_list(F.struct("f", "h")))
    common = rows.join(shared, "h").groupBy("key").agg(order.alias("o")).select("key", F.col("o.h").alias("rare"))
    return sets.select("key", F.size("s").alias("n")).join(common, "key", "left").select(
        "key", "n", (F.col("n") - F.coalesce(F.size("rare"), F.lit(0))).alias("alone"), "rare"
    )


def _needed(n: Column, m: Column, least: float) -> Column:
    """Shingles that sets of sizes n and m must share; a little less, against rounding."""
    return F.lit(least / (1 + least) - 1e-9) * (n + m)


def _linked(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of keys whose sets are similar enough, by their whole sets."""
    one, other = sets.select(F.col("key").alias("a"), F.col("s").alias("x")), sets.select(F.col("key").alias("b"), F.col("s").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    found = pairs.join(one, "a").join(other, "b").select("a", "b", both.alias("c"), (F.size("x") + F.size("y")).alias("n"))
    return found.filter(F.col("c") >= least * (F.col("n") - F.col("c"))).select("a", "b")


def near_copies(documents: DataFrame, width: int = WIDTH, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_key, root) of every row: rows share a root if links of similarity `least` join their texts.

    Texts with the same set of shingles are one from the start. Sets that meet in no band are alone; so are those of whose
    shingles too many are in no other set. In each band the rest are compared with the most typical set there, which has
    the fewest shingles of its own, and once more with the most typical of those still apart. What then shares a band but
    no root is joined on the rarest `n - least * n + 1` shingles of each set, since two similar sets share one of them, and only
    where sizes and places leave room for enough common ones. So no link is left out, and a group of copies makes few pairs.

    A null or wordless text is a set of its own kind, which all such rows share; a text of fewer words than `width` is one
    shingle. Rows of the same text, repeated rows and rows with a null id get the root of their text; the ids are not
    looked at. An empty table gives none; other columns are not carried.
    """
    prints = cut_lineage(_sketches(documents, width))
    rows = prints.groupBy("key").agg(F.first("n").alias("n"), F.first("bands").alias("bands")).select(
        "key", F.posexplode("bands").alias("i", "v")
    )
    shared = rows.groupBy("i", "v").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("i", "v")
    met = cut_lineage(rows.join(shared, ["i", "v"]))
    needed = met.select("key").distinct().join(prints.select("key", "text_key"), "key").groupBy("key").agg(
        F.min("text_key").alias("text_key")
    )
    sets = cut_lineage(_sets(documents, needed, width))
    ranked = cut_lineage(_ranked(sets).filter(F.col("n") - F.col("alone") >= least * F.col("n") - 1e-9))
    near = cut_lineage(met.join(ranked.select("key", "n", "alone"), "key"))
    linked = None
    roots = ranked.select("key", F.col("key").alias("root"))
    for _ in range(2):
        placed = near.join(roots, "key")
        # The most typical set of each band, then of those that its component lacks.
        typical = F.min(F.struct("alone", "key", "n", "root"))
        first = placed.groupBy("i", "v").agg(typical.alias("t"))
        if linked is not None:
            first = placed.join(first, ["i", "v"]).filter(F.col("root") != F.col("t.root")).groupBy("i", "v").agg(typical.alias("t"))
        room = F.least(F.col("n") - F.col("alone"), F.col("t.n") - F.col("t.alone")) >= _needed(F.col("n"), F.col("t.n"), least)
        stars = placed.join(first, ["i", "v"]).filter((F.col("root") != F.col("t.root")) & room).select(
            F.col("key").alias("a"), F.col("t.key").alias("b")
        ).distinct()
        more = cut_lineage(_linked(stars, sets, least))
        linked = more if linked is None else linked.union(more)
        roots = cut_lineage(ranked.select("key").join(connected(linked).withColumnRenamed("node", "key"), "key", "left").select(
            "key", F.coalesce("root", "key").alias("root")
        ))
    placed = near.join(roots, "key")
    mixed = placed.groupBy("i", "v").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    apart = placed.join(mixed.select("i", "v"), ["i", "v"], "left_semi").select("key", "root").distinct().join(ranked, "key")
    # A set's own shingles come first in the order from the rarest, so the shared ones start at place `alone`.
    prefix = F.slice("rare", F.lit(1), F.greatest(F.lit(0), F.col("n") - F.ceil(least * F.col("n") - F.lit(1e-9)).cast("int") + 1 - F.col("alone")))
    tokens = cut_lineage(apart.select("key", "root", "n", "alone", F.posexplode(prefix).alias("p", "h")).select(
        "key", "root", "n", (F.col("n") - F.col("alone") - F.col("p")).alias("rest"), "h"
    ))
    x, y = tokens.alias("x"), tokens.alias("y")
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.key") < F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & (
        F.least("x.rest", "y.rest") >= _needed(F.col("x.n"), F.col("y.n"), least)
    )).select(F.col("y.key").alias("a"), F.col("x.key").alias("b")).distinct()
    more = cut_lineage(_linked(pairs, sets, least))
    if not more.isEmpty():
        roots = connected(linked.union(more)).withColumnRenamed("node", "key")
    return prints.select("doc_id", "text_key", "key").join(roots, "key", "left").select(
        "doc_id", "text_key", F.coalesce("root", "key").alias("root")
    )
