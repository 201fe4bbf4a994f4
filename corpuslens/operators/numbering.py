"""Consecutive numbers over a whole table without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.session import cut_lineage

_ROW_BITS = 33


def numbered(df: DataFrame, *order: str | Column, name: str = "number") -> DataFrame:
    """`df` with consecutive numbers from 0 in an order.

    The rows are dealt into ranges, each range is sorted on its own and adds the rows of the ranges before it. The sorted
    rows are written once, so the numbers stay if a task is run again; what is summed is one row per range.
    """
    at = F.col("_at")
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright(at, _ROW_BITS))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    every = sizes.agg(F.collect_list(F.struct("_part", "n"))).scalar()
    before = F.aggregate(F.filter("_every", lambda x: x["_part"] < F.col("_part")), F.lit(0).cast("long"), lambda sum_, x: sum_ + x["n"])
    # One row for each range.
    starts = F.broadcast(sizes.withColumn("_every", every).select("_part", before.alias("_before")))
    number = F.col("_before") + at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(starts, "_part").withColumn(name, number).drop("_at", "_part", "_before")
