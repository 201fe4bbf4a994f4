"""Batches of like lengths: dynamic programming over the global histogram chooses the buckets that pad least."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.common import table, words_of
from corpuslens.session import cut_lineage

#: Documents per slice of the id range when places are counted.
SLICE = 4096


def grid(n: Column) -> Column:
    """Lengths to 127 as they are, longer ones rounded up to seven binary digits: at most 64 values per doubling."""
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(n)) - 7, F.lit(0)))
    return F.ceil(n / step).cast("long") * step


def choose_boundaries(values: np.ndarray, rows: np.ndarray, tokens: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most `buckets` buckets with the least padding; among equals the lowest bounds.

    The histogram has one entry per grid value, so it is small at any size of the corpus.
    """
    m = len(values)
    if not m:
        return []
    r, t = np.concatenate(([0], np.cumsum(rows))), np.concatenate(([0], np.cumsum(tokens)))
    best = values * r[1:] - t[1:]  # one bucket for the first j values
    back = []
    for _ in range(1, min(buckets, m)):
        fresh, start = best.copy(), np.full(m, -1)
        for j in range(m):
            if j:
                cost = best[:j] + values[j] * (r[j + 1] - r[1 : j + 1]) - (t[j + 1] - t[1 : j + 1])
                i = int(cost.argmin())
                if cost[i] < fresh[j]:
                    fresh[j], start[j] = cost[i], i
        back.append(start)
        best = fresh
    bounds, j = [], m - 1
    for start in reversed(back):
        if start[j] >= 0:  # else fewer buckets do as well
            bounds.append(int(values[j]))
            j = int(start[j])
    bounds.append(int(values[j]))
    return bounds[::-1]


def pack(documents: DataFrame, n_tokens: Column, buckets: int = 12, token_budget: int = 65536) -> DataFrame:
    """(doc_id, n_tokens, bucket_tokens, batch, slot) of every row.

    A bucket holds the lengths over the bound below it, up to `bucket_tokens`; a batch of it has as many rows as pad to
    `token_budget` (one at least), in the order of ids, nulls first; `batch` counts from 0 in its bucket, `slot`
    in its batch. A null or empty text has length 0. Repeated rows get places of their own; an empty table gives none.
    Other columns are not carried. Places come from sums per slice of the id range, so no bucket meets in one task.
    """
    lengths = cut_lineage(documents.select("doc_id", n_tokens.cast("long").alias("n_tokens")).groupBy("doc_id", "n_tokens").agg(
        F.count(F.lit(1)).alias("c")
    ))
    histogram = lengths.groupBy(grid(F.col("n_tokens")).alias("v")).agg(
        F.sum("c").alias("rows"), F.sum(F.col("c") * F.col("n_tokens")).alias("tokens")
    ).orderBy("v").collect()  # 64 rows per doubling of the length
    bounds = choose_boundaries(*(np.array([h[c] for h in histogram], np.int64) for c in ("v", "rows", "tokens")), buckets)
    upper = F.lit(bounds[-1] if bounds else 0)
    for b in reversed(bounds[:-1]):
        upper = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(upper)
    placed = lengths.withColumns({"bucket_tokens": upper.cast("long"), "_slice": F.floor(F.col("doc_id") / SLICE)})
    order = Window.partitionBy("bucket_tokens").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("bucket_tokens", "_slice").agg(F.sum("c").alias("s")).withColumn(
        "_before", F.coalesce(F.sum("s").over(order), F.lit(0))
    ).select(F.col("bucket_tokens").alias("_b"), F.col("_slice").alias("_s"), "_before")
    inside = Window.partitionBy("bucket_tokens", "_slice").orderBy("doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.withColumn("_in", F.coalesce(F.sum("c").over(inside), F.lit(0))).join(
        offsets, (F.col("bucket_tokens") == F.col("_b")) & F.col("_slice").eqNullSafe(F.col("_s"))
    )
    # Equal rows travel as one and are dealt out in blocks.
    blocks = ranked.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("c") - 1) / SLICE))))
    each = blocks.withColumn("_i", F.explode(F.sequence(
        F.col("_k") * SLICE, F.least(F.col("c"), (F.col("_k") + 1) * SLICE) - 1
    )))
    place = F.col("_before") + F.col("_in") + F.col("_i")
    capacity = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest(F.col("bucket_tokens"), F.lit(1))))
    return each.select(
        "doc_id", "n_tokens", "bucket_tokens", F.floor(place / capacity).alias("batch"), (place % capacity).alias("slot")
    )


def pack_words(documents: DataFrame) -> DataFrame:
    return pack(documents, F.size(words_of(F.col("text"))))


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document by its number of words."""
    return pack_words(table(spark, sf_dir, "documents"))


def sql(source: str = "documents", buckets: int = 12, token_budget: int = 65536) -> str:
    """The same search spelled out step by step: f0 has one bucket, f1 up to two, and so on."""
    steps = ["f0 as (select j, v * r - t as cost, [v] as bounds from h)"]
    for k in range(1, buckets):
        steps.append(f"""f{k} as (select j, min(cost) as cost, arg_min(bounds, (cost, rank)) as bounds from (
            select j, cost, bounds, -1 as rank from f{k - 1} union all
            select b.j, a.cost + b.v * (b.r - x.r) - (b.t - x.t), list_append(a.bounds, b.v), a.j
            from f{k - 1} a join h x on x.j = a.j join h b on b.j > a.j) group by j)""")
    step = "(1::bigint << greatest(length(bin(n_tokens)) - 7, 0))"
    return f"""with lengths as (select doc_id,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as n_tokens from {source}),
    counts as (select ((n_tokens + {step} - 1) // {step}) * {step} as v, count(*) as rows, sum(n_tokens)::bigint as tokens
        from lengths group by 1),
    h as (select v, row_number() over (order by v) as j, (sum(rows) over (order by v))::bigint as r,
        (sum(tokens) over (order by v))::bigint as t from counts),
    {', '.join(steps)},
    chosen as (select bounds from f{buckets - 1} where j = (select max(j) from h)),
    placed as (select doc_id, n_tokens, list_min(list_filter(bounds, lambda b: b >= n_tokens)) as bucket_tokens from lengths, chosen),
    ranked as (select *, row_number() over (partition by bucket_tokens order by doc_id nulls first, n_tokens) - 1 as place,
        greatest(1, {token_budget} // greatest(bucket_tokens, 1)) as capacity from placed)
    select doc_id, n_tokens, bucket_tokens, place // capacity as batch, place % capacity as slot from ranked"""


SQL = sql()
