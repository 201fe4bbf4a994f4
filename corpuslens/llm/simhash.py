"""SimHash near-duplicates: fingerprints, links within a few bits by Gray-order hierarchical indexes, components.

Fingerprints that differ in at most d bits agree on one of d + 1 bit blocks, so Spark routes each distinct fingerprint to
d + 1 groups. A group is searched by its own index; a group over `leaf_rows` is routed once more by blocks of its other
bits. What is still too large is a dense cluster, and is linked through shared flips. Each step is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import table
from corpuslens.llm.components import connected
from corpuslens.llm.minhash import near_copies
from corpuslens.session import cut_lineage

BITS = 64


def fingerprint_of(data: bytes, width: int = 4, seed: int = 42, block: int = 1 << 16) -> int:
    """Majority bits of the shingle hashes; 0 without words."""
    words = data.lower().split()  # A-Z and the six white characters only, as these are bytes
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(width, len(words))
    n = len(words) - width + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for i in range(0, n, block):
        j = min(n, i + block)
        spans = zip(starts[i:j].tolist(), ends[i + width - 1 : j + width - 1].tolist(), strict=True)
        h = np.fromiter((digest(joined[a:z], seed) for a, z in spans), ">u8", j - i)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def fingerprint(data: pd.Series) -> pd.Series:
    return pd.Series([0 if x is None else fingerprint_of(x) for x in data], dtype="int64")


def hex_digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


# The index of one group -------------------------------------------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order, in which neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def build_index(codes: np.ndarray, fan: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the top down to the codes: each node has the bits that all its members share and that no node
    above has yet (mask), and their values (pattern). `codes` must be in Gray order."""
    mask, value, levels = np.full(len(codes), ~np.uint64(0)), codes, []
    while True:
        levels.append([mask, value])
        if len(mask) <= fan:
            break
        at = np.arange(0, len(mask), fan)
        every, any_ = np.bitwise_and.reduceat(value & mask, at), np.bitwise_or.reduceat(value | ~mask, at)
        mask = np.bitwise_and.reduceat(mask, at) & ~(every ^ any_)
        value = every & mask
    levels.reverse()
    for i in range(len(levels) - 1, 0, -1):
        above = np.repeat(levels[i - 1][0], fan)[: len(levels[i][0])]
        levels[i][0] = levels[i][0] & ~above
    return [(m, v & m) for m, v in levels]


def close_pairs(codes: np.ndarray, distance: int, fan: int = 8, block: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of codes in Gray order within `distance`, block of queries by block.

    A query walks down with the differences summed so far; a node whose sum is too large goes with all below it.
    """
    levels, n = build_index(codes, fan), len(codes)
    for start in range(0, n, block):
        q = np.arange(start, min(n, start + block))
        top = len(levels[0][0])
        query, node, total = np.repeat(q, top), np.tile(np.arange(top), len(q)), np.zeros(len(q) * top, np.int64)
        for depth, (mask, value) in enumerate(levels):
            if depth:
                query, node, total = np.repeat(query, fan), (node[:, None] * fan + np.arange(fan)).ravel(), np.repeat(total, fan)
                real = node < len(mask)
                query, node, total = query[real], node[real], total[real]
            last = (node + 1) * fan ** (len(levels) - 1 - depth) - 1
            total = total + np.bitwise_count((codes[query] ^ value[node]) & mask[node])
            keep = (total <= distance) & (last > query)
            query, node, total = query[keep], node[keep], total[keep]
        yield query, node


def forest(codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Each code of a group that has links, with the first code of its component: at most one row a code."""
    order = np.argsort(gray_rank(codes))
    codes = codes[order]
    label = np.arange(len(codes))
    for i, j in close_pairs(codes, distance):
        while len(i):
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(label, label[label]):
                label = label[label]
    far = np.nonzero(label != np.arange(len(codes)))[0]
    return codes[far], codes[label[far]]


# The job ----------------------------------------------------------------------------------------------------


def _blocks(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """`parts` runs of bits (first, width) that cover low..high."""
    cuts = [low + (high - low) * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _part(code: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1))


def _search(groups: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links of every group, found task by task; a group is whole in one task and has a bounded size."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = pd.DataFrame()

        def found(rows: pd.DataFrame) -> pd.DataFrame:
            code = rows["fp"].to_numpy().view(np.uint64)
            key = rows[keys].to_numpy()
            cut = np.nonzero((key[1:] != key[:-1]).any(axis=1))[0] + 1
            out = [forest(x, distance) for x in np.split(code, cut) if len(x) > 1]
            a, b = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.uint64) for k in (0, 1))
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for batch in batches:
            rest = pd.concat([rest, batch], ignore_index=True)
            ends = (rest[keys] != rest[keys].iloc[-1]).any(axis=1).to_numpy()
            done = int(np.nonzero(ends)[0][-1]) + 1 if ends.any() else 0
            if done:
                yield found(rest.iloc[:done])
                rest = rest.iloc[done:]
        if len(rest):
            yield found(rest)

    return groups.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(links, "a long, b long")


def _shared_flips(codes: DataFrame, distance: int) -> DataFrame:
    """Links of dense clusters: codes within `distance` meet at a code that at most half the flips reach from either.

    Each code yields a fixed number of flipped codes; all codes at one of them are within `distance` of each other,
    and each is linked to the smallest.
    """
    masks = [0]
    for _ in range(distance // 2):
        masks = sorted({m ^ bit for m in masks for bit in [0, *(1 << i for i in range(BITS))]})
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    near = codes.sparkSession.createDataFrame([(signed,)], "masks array<long>")
    met = codes.join(F.broadcast(near)).select("fp", F.explode("masks").alias("m")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("m")).alias("at")
    )
    if distance % 2:  # one side flips once more
        ones = F.array(*[F.lit(x) for x in [0, *np.array([1 << i for i in range(BITS)], np.uint64).view(np.int64).tolist()]])
        first = met.groupBy("at").agg(F.min("fp").alias("b"))
        wide = met.select("fp", F.explode(F.transform(ones, lambda m: F.col("at").bitwiseXOR(m))).alias("at"))
        return wide.join(first, "at").select(F.col("fp").alias("a"), "b").filter("a != b").distinct()
    first = met.groupBy("at").agg(F.min("fp").alias("b"))
    return met.join(first, "at").select(F.col("fp").alias("a"), "b").filter("a != b").distinct()


def links(codes: DataFrame, distance: int = 4, leaf_rows: int = 4096) -> DataFrame:
    """Links (a, b) between the distinct codes `fp` that span every component of codes within `distance`.

    Exact at every size: groups up to `leaf_rows` are searched, larger ones routed by further bits, and what stays
    larger meets at shared flips. No group gives more links than it has codes.
    """
    first = _blocks(0, BITS, distance + 1)
    routes = F.array(*[F.struct(F.lit(i).alias("i"), _part(F.col("fp"), s, w).alias("v")) for i, (s, w) in enumerate(first)])
    routed = codes.select("fp", F.inline(routes))
    large = cut_lineage(routed.groupBy("i", "v").count().filter(F.col("count") > leaf_rows).select("i", "v"))
    out = [_search(routed.join(large, ["i", "v"], "left_anti"), ["i", "v"], distance)]
    if not large.isEmpty():
        again = routed.join(large, ["i", "v"], "left_semi")
        # The bits outside block i, turned to the low end, in blocks of their own.
        def inner(i: int) -> Column:
            s, w = first[i]
            turned = F.shiftrightunsigned("fp", s + w).bitwiseOR(F.shiftleft("fp", BITS - s - w)) if s + w < BITS else F.col("fp")
            return F.array(*[
                F.struct(F.lit(j).alias("j"), _part(turned, a, b).alias("u"))
                for j, (a, b) in enumerate(_blocks(0, BITS - w, distance + 1))
            ])
        choice = F.coalesce(*[F.when(F.col("i") == i, inner(i)) for i in range(len(first))])
        finer = cut_lineage(again.select("fp", "i", "v", F.inline(choice)))
        keys = ["i", "v", "j", "u"]
        dense = cut_lineage(finer.groupBy(*keys).count().filter(F.col("count") > leaf_rows).select(*keys))
        out.append(_search(finer.join(dense, keys, "left_anti"), keys, distance))
        if not dense.isEmpty():
            out.append(_shared_flips(finer.join(dense, keys, "left_semi").select("fp").distinct(), distance))
    spanned = out[0]
    for more in out[1:]:
        spanned = spanned.union(more)
    return spanned


def near_duplicates(documents: DataFrame, distance: int = 4, leaf_rows: int = 4096) -> DataFrame:
    """(doc_id, text_key, fp, component_id) of every row: `component_id` is the smallest id reachable over links.

    A null or wordless text has fingerprint 0 and is linked like any other. Rows with a null id link others
    but lend no id: a component of such rows only has a null one. Repeated rows and ties share a fingerprint. An empty
    table gives none; other columns are not carried. Texts are read once; from then on only keys move.
    """
    prints = cut_lineage(documents.select(
        "doc_id", F.xxhash64("text").alias("text_key"), fingerprint(F.col("text").cast("binary")).alias("fp")
    ))
    codes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected(links(codes.select("fp"), distance, leaf_rows))
    rooted = codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return prints.join(named, "fp").select("doc_id", "text_key", "fp", "component_id", "root")


def all_copies(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, root) of every row: rows share a root if links of `near_copies` (5-word similarity of 0.8 or more) and
    of `near_duplicates` (fingerprints of four words within four bits), in any order, join their texts.

    Neither finds what the other does: most pairs of a similarity near 0.8 lie more than four bits apart, and copies with
    many small edits keep their fingerprint below that similarity. Odd rows as in these two.
    """
    alike = cut_lineage(near_copies(documents))
    links = None
    for groups in (alike, near_duplicates(documents)):
        texts = cut_lineage(groups.select("text_key", "root").distinct())
        first = texts.groupBy("root").agg(F.min("text_key").alias("b"))
        found = texts.join(first, "root").select(F.col("text_key").alias("a"), "b").filter("a != b")
        links = found if links is None else links.union(found)
    roots = connected(links).withColumnRenamed("node", "text_key")
    return alike.select("doc_id", "text_key").join(roots, "text_key", "left").select(
        "doc_id", "text_key", F.coalesce("root", "text_key").alias("root")
    )


def keep_one(documents: DataFrame, find: Callable[[DataFrame], DataFrame] = near_copies) -> DataFrame:
    """One row of each group of near copies that `find` gives, by itself those of 5-word similarity, whole: that with the
    smallest id (a null last), then the smallest text key.

    Null, empty and blank texts are copies of each other; repeated rows leave one; long texts are compared whole. Columns
    of any name stay as they are; an empty table gives none.
    """
    groups = cut_lineage(find(documents))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))
    chosen = groups.groupBy("root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("id"), F.col("k.text_key").alias("key"))
    keyed = documents.select(F.struct(*documents.columns).alias("row"), F.xxhash64("text").alias("key"), F.col("doc_id").alias("id"))
    # Equal rows are cut to one in each task before they move.
    once = keyed.withColumn("n", F.expr("row_number() over (partition by id, key order by id)")).filter("n = 1")
    stays = once.alias("d").join(
        chosen.alias("c"), F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.key") == F.col("c.key")), "left_semi"
    )
    return stays.select("row.*")


def op1_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; nulls, empty and long texts, ties, repeated rows and empty tables as in
    `near_duplicates`."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
