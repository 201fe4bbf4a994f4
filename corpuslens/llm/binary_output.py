"""Token ids in packed matrices: best-fit-decreasing packing of documents, long ones split without loss, written as rows of
fixed width with cumulative segment lengths and position resets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpuslens.llm.common import table
from corpuslens.session import working_path

PAD, END, BYTE = 0, 1, 3  # id of byte b is b + BYTE


class Capacities:
    """Bins by free space in a segment tree: the tightest bin that still fits is found in log(width) steps."""

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, free: int, bin_: int) -> None:
        self.bins[free].append(bin_)
        self._change(free, 1)

    def _change(self, free: int, by: int) -> None:
        i = free + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, bin) of the smallest free space of at least `need`, taken out; None without one."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        free = i - self.size
        self._change(free, -1)
        return free, self.bins[free].pop()


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """Bins of indexes into `lengths`, each filled to at most `width`: longest first, into the tightest bin that fits."""
    free, bins = Capacities(width), []
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        found = free.take(lengths[i])
        if found is None:
            bins.append([])
            found = (width, len(bins) - 1)
        space, at = found
        bins[at].append(i)
        if space > lengths[i]:
            free.add(space - lengths[i], at)
    return bins


def byte_ids(text: str | None) -> np.ndarray:
    """UTF-8 bytes as ids, then the end mark."""
    return np.append(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint16) + BYTE, END).astype(np.uint16)


SCHEMA = (
    "shard string, row int, n_tokens int, doc_ids array<long>, doc_offsets array<long>, cu_seqlens array<int>, "
    "position_resets array<int>, input_ids binary"
)


def pack_documents(documents: DataFrame, width: int = 4096, shard_tokens: int = 1 << 22, tokenize=byte_ids) -> DataFrame:
    """Rows of `width` 16-bit ids: `input_ids` (little-endian, padded with 0), the ids of the documents in them, where in
    its document each segment starts, cumulative segment lengths from 0, and the places where positions start again.

    A document is split at `width` ids; whole parts fill rows of their own, the rests are packed best fit decreasing
    within shards of about `shard_tokens` ids that follow the input, so nothing is shuffled and a task holds one shard. A
    null text counts as empty and is its end mark alone; rows with the same or a null id are packed each; an empty
    table gives no rows; other columns are not carried.
    """

    layout = to_arrow_schema(T.StructType.fromDDL(SCHEMA))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, shard, held, size = task.partitionId() if task else 0, 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal shard
            pieces = [(doc, at, ids[at : at + width]) for doc, ids in held for at in range(0, len(ids), width)]
            rows = []
            for k, members in enumerate(best_fit([len(p[2]) for p in pieces], width)):
                lengths = [len(pieces[i][2]) for i in members]
                ids = np.full(width, PAD, "<u2")
                ids[: sum(lengths)] = np.concatenate([pieces[i][2] for i in members])
                ends = np.cumsum(lengths).tolist()
                rows.append((
                    f"{part:06d}-{shard:04d}", k, ends[-1], [pieces[i][0] for i in members], [pieces[i][1] for i in members],
                    [0, *ends], [0, *ends[:-1]], ids.tobytes(),
                ))
            shard += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), layout, strict=True)], schema=layout)

        for b in batches:
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), strict=True):
                ids = tokenize(text)
                held.append((doc, ids))
                size += len(ids)
                if size >= shard_tokens:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(packed, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> DataFrame:
    """Writes the rows as Parquet and reads them from there. Spark commits whole files, so a task that is lost leaves none."""
    packed.write.option("compression", "zstd").parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path)


def op7_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packs all documents, writes the matrices, and returns each written row with the digest of its ids."""
    written = write_packed(pack_documents(table(spark, sf_dir, "documents")), working_path(spark, "packed"))
    return written.select(
        "shard", "row", "n_tokens", "doc_ids", "doc_offsets", "cu_seqlens", "position_resets",
        F.sha2("input_ids", 256).alias("ids_sha256"),
    )
