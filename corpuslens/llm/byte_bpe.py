"""Byte-level BPE over chunks: long texts are pre-tokenised chunk by chunk in parallel and stitched where the boundaries
of neighbours meet again; decoding joins raw bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import table


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, one pair a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    """Ids of pre-tokens, remembered for the pre-tokens met lately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remembered: int = 1 << 17):
        import tiktoken

        self.pattern, self.remembered, self.known = regex.compile(pattern), remembered, {}
        self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._encode_single_piece

    def ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit numbers."""
        known = self.known
        new = set(pieces).difference(known)
        if new:
            if len(known) + len(new) > self.remembered:
                known.clear()
                new = set(pieces)
            for p in new:
                known[p] = np.array(self.merge(p.encode("utf-8", "surrogatepass")), "<i4").tobytes()
        return [known[p] for p in pieces]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(self.ids(self.pattern.findall(text))), "<i4")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int32)]).astype(np.int32)))


#: Characters that a pre-token's end can depend on beyond it.
LONGEST_SUFFIX = 3


def stitch(chunks: pd.DataFrame, pattern: regex.Pattern, chunk: int) -> Iterator[tuple[int, int, int] | str]:
    """What makes up one text: (chunk, first piece, end piece) runs, and pre-tokens that had to be found anew.

    `chunks` has, in order, start, text and starts (of its pre-tokens, from the text's beginning). A pre-token that ends
    well before its chunk does is right if it begins right, since the pattern never looks back; so from the first
    boundary that both neighbours share, the right one goes on. Where they share none in the overlap, pre-tokens
    are found one by one until a boundary of a later chunk is met.
    """
    n = len(chunks)
    whole = "".join(t[:chunk] for t in chunks["text"][:-1]) + chunks["text"].iloc[-1]
    starts, ends = [], []
    for first, text, s in zip(chunks["start"], chunks["text"], chunks["starts"], strict=True):
        s = np.asarray(s, np.int64)
        starts.append(s)
        ends.append(np.append(s[1:], first + len(text)))
    k, at = 0, 0
    while at < len(whole):
        i = int(np.searchsorted(starts[k], at))
        if k == n - 1:
            yield k, i, len(starts[k])
            return
        # A cut inside 're, 'll or 've ends the mark too early, so what ends near the cut isn't trusted either.
        right = ends[k][i:] + LONGEST_SUFFIX < chunks["start"].iloc[k] + len(chunks["text"].iloc[k])
        stop = i + int(right.sum())
        common = np.intersect1d(ends[k][i:stop], starts[k + 1])
        if len(common):
            at = int(common[0])
            yield k, i, int(np.searchsorted(ends[k], at)) + 1
            k += 1
            continue
        if stop > i:
            yield k, i, stop
            at = int(ends[k][stop - 1])
        while at < len(whole):  # rare: one pre-token longer than the overlap
            found = pattern.match(whole, at)
            yield found.group()
            at = found.end()
            later = [j for j in range(k + 1, n) if starts[j][0] <= at <= starts[j][-1]]
            k = next((j for j in later if starts[j][np.searchsorted(starts[j], at)] == at), -1) if later else -1
            if k >= 0:
                break
            k = min(int(np.searchsorted(chunks["start"], at, "right")) - 1, n - 2)


def encode(
    documents: DataFrame, ranks: dict[bytes, int], pattern: str, chunk: int = 1 << 16, overlap: int = 1 << 10,
) -> DataFrame:
    """`documents` with `tokens`, the ids of the whole text in order.

    Texts up to `chunk` characters are encoded in one go, where they are read. Longer ones become rows of chunks that
    overlap, are spread over the tasks, pre-tokenised and encoded there, and stitched per text. A null text counts as
    empty and has no ids; other columns, repeated rows, null and repeated ids stay as they are; own columns of the
    same name are replaced.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(ranks)  # a vocabulary, the same at every size
    rows = documents.drop("tokens")
    schema = T.StructType([*rows.schema.fields, T.StructField("tokens", T.ArrayType(T.IntegerType()))])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern)
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                ids = [encoder.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(ids)], [*part.schema.names, "tokens"])

    size = F.coalesce(F.length("text"), F.lit(0))
    near = rows.filter(size <= chunk).mapInArrow(short, schema)
    key = "_row"
    while key in rows.columns:
        key += "_"
    long = rows.filter(size > chunk).withColumn(key, F.monotonically_increasing_id())
    width = chunk + overlap

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row, text in zip(b["_row"], b["text"], strict=True):
                at = range(0, max(1, len(text) - overlap), chunk)
                yield pd.DataFrame({"_row": row, "start": list(at), "text": [text[a : a + width] for a in at]})

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value, pattern)
        for b in batches:
            for row, start, text in zip(b["_row"], b["start"], b["text"], strict=True):
                found = encoder.pattern.findall(text)
                ids = encoder.ids(found)
                lengths = np.fromiter(map(len, found), np.int64, len(found))
                yield pd.DataFrame({
                    "_row": [row], "start": [start], "text": [text], "starts": [start + np.cumsum(lengths) - lengths],
                    "counts": [np.fromiter(map(len, ids), np.int64, len(ids)) // 4], "ids": [np.frombuffer(b"".join(ids), "<i4")],
                })

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        encoder = Encoder(shared.value, pattern)
        group = group.sort_values("start").reset_index(drop=True)
        marks = [np.concatenate(([0], np.cumsum(c))) for c in group["counts"]]
        out = []
        for x in stitch(group, encoder.pattern, chunk):
            out.append(encoder.encode(x) if isinstance(x, str) else group["ids"][x[0]][marks[x[0]][x[1]] : marks[x[0]][x[2]]])
        return pd.DataFrame({"_row": group["_row"].iloc[:1], "tokens": [np.concatenate(out)]})

    encoded = long.select(F.col(key).alias("_row"), "text").mapInPandas(cut, "_row long, start long, text string").repartition(
        "_row", "start"
    ).mapInPandas(pieces, "_row long, start long, text string, starts array<long>, counts array<long>, ids array<int>").groupBy(
        "_row"
    ).applyInPandas(whole, "_row long, tokens array<int>")
    found = encoded.select(F.col("_row").alias(key), F.col("tokens"))
    return near.unionByName(long.join(found, key).drop(key))


def decoder(spark: SparkSession, ranks: dict[bytes, int]):
    """Function of a column of ids that gives their bytes."""
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def decoded(tokens: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = {i: b for b, i in shared.value.items()}.__getitem__
        for batch in tokens:
            yield pd.Series([None if ids is None else b"".join(map(of, ids.tolist())) for ids in batch])

    return decoded


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every document, and the digest of the bytes that they decode to."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return encoded.select(
        "doc_id", F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decoder(spark, ranks)("tokens"), 256).alias("decoded_sha256"),
    )
