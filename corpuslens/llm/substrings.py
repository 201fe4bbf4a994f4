"""Repeated passages by prefix-partitioned suffix trees over words.

A suffix is a place in a document with at least `window` words from there on. Prefixes of 1, 2, 4, 8, 16 words deal the
suffixes out to groups of one task's size: a prefix that holds more than a group's share is split by its next words, so
prefixes vary in length and even a passage that half the corpus shares ends in a group of its own. Each block of documents
first joins its suffixes at the nodes `window` words deep and hands on the earliest leaf of each node, which bounds what a
popular passage sends; every other leaf there is known to be a repeat. A group then builds its subtree at that depth from
the leaves of all blocks: whatever shares a node with an earlier leaf is repeated. Runs of repeated leaves in a document are
its maximal repeats.

The path to a node is held as 64 bits, never as words. Different paths are taken for one only if they also have the same
group, which for 135 million words has odds of 1 to 100,000, and at 10^13 words concerns about one window in 10^11.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import table
from corpuslens.session import cut_lineage

WINDOW = 20
#: Leaves of a group, at most 40 bytes each while a task works on them.
GROUP_LEAVES = 1 << 21
#: Bytes that a word and its gap take on average, or more; with shorter words groups grow accordingly.
WORD_BYTES = 4
#: Words of a block of documents.
BLOCK_WORDS = 1 << 20
K1, K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def pieces(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, about `size` bytes at a time, cut only at white space."""
    start = 0
    while start < len(data):
        end = start + size
        if end < len(data):
            while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
                end += 1
        yield data[start:end].split()
        start = end


def word_hashes(data: bytes) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    parts = [np.fromiter(map(digest, words), np.uint64, len(words)) for words in pieces(data)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of two adjoining paths as one."""
    x = (a ^ (a >> np.uint64(32))) * K1 + b
    return (x ^ (x >> np.uint64(29))) * K2


def steps(window: int) -> list[int]:
    """Depths at which a path is known: powers of two, then the window."""
    out = [1]
    while 2 * out[-1] < window:
        out.append(2 * out[-1])
    return out if out[-1] == window else [*out, window]


def paths(words: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(depth, hash of the path of that depth from each place) from the root down to `window`."""
    depth, known = 1, {1: words}
    yield 1, words
    while 2 * depth <= window:
        last = known[depth]
        known[2 * depth] = _join(last[:-depth], last[depth:]) if len(last) > depth else last[:0]
        depth *= 2
        yield depth, known[depth]
    if depth < window:
        path, have = known[depth], depth
        while have < window:  # the powers of two that are left, from the largest
            more = max(d for d in known if have + d <= window)
            path = _join(path[: max(0, len(path) - more)], known[more][have : have + max(0, len(path) - more)])
            have += more
        yield window, path


class Block:
    """Documents, each once and in order of (id, key), with their words end to end."""

    def __init__(self, ids: list[int], keys: list[int], hashes: list[np.ndarray], window: int):
        seen = {}
        for i, place in enumerate(zip(ids, keys, strict=True)):
            seen.setdefault(place, i)
        order = [seen[p] for p in sorted(seen)]
        self.ids, self.keys = np.array([ids[i] for i in order], np.int64), np.array([keys[i] for i in order], np.int64)
        sizes = np.array([len(hashes[i]) for i in order], np.int64)
        self.base = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        self.words = np.concatenate([hashes[i] for i in order]) if order else np.zeros(0, np.uint64)
        counts = np.maximum(sizes - (window - 1), 0)
        first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        self.starts = np.arange(counts.sum()) - np.repeat(first - self.base, counts)


def blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[Block]:
    """Blocks of about `BLOCK_WORDS` words from rows (place, key, text)."""
    ids, keys, hashes, words = [], [], [], 0
    for batch in batches:
        for i, key, text in zip(batch["place"].to_pylist(), batch["key"].to_pylist(), batch["text"], strict=True):
            found = word_hashes(text.as_buffer().to_pybytes()) if text.is_valid else np.zeros(0, np.uint64)
            if len(found) < window:
                continue
            ids.append(i), keys.append(key), hashes.append(found)
            words += len(found)
            if words >= BLOCK_WORDS:
                yield Block(ids, keys, hashes, window)
                ids, keys, hashes, words = [], [], [], 0
    if ids:
        yield Block(ids, keys, hashes, window)


# Prefixes ---------------------------------------------------------------------------------------------------


def _held_often(documents: DataFrame, window: int, share: float) -> DataFrame:
    """(depth, path, n) of the prefixes that hold more than `share` of a block; depth 0 counts the block's suffixes.

    A prefix with more than that share of all suffixes has it in some block, so none is missed; what blocks with less of
    it leave uncounted is under the share again.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, window):
            at, least = block.starts, share * len(block.starts)
            rows = [(np.zeros(1, np.uint64), np.array([len(at)]), 0)]
            for depth, path in paths(block.words, window):
                value, inverse, n = np.unique(path[at], return_inverse=True, return_counts=True)
                heavy = n > least
                rows.append((value[heavy], n[heavy], depth))
                at = at[heavy[inverse]]
                if depth == window or not len(at):
                    break
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.full(len(v), d, np.int32) for v, _, d in rows])),
                pa.array(np.concatenate([v for v, _, _ in rows]).view(np.int64)),
                pa.array(np.concatenate([n for _, n, _ in rows]).astype(np.int64)),
            ], names=["depth", "path", "n"])

    found = documents.mapInArrow(count, "depth int, path long, n long")
    return found.groupBy("depth", "path").agg(F.sum("n").alias("n"))


def split_prefixes(documents: DataFrame, window: int, group_leaves: int) -> tuple[dict[int, np.ndarray], int]:
    """Paths by depth that are too large for a group and so go on to the next depth; and the number of groups.

    At most `groups` paths of a depth hold over their share, so at most 5 * groups numbers are kept for any corpus.
    """
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(least, -(-size // (WORD_BYTES * group_leaves)))
    counts = cut_lineage(_held_often(documents, window, 1 / groups))
    total = counts.filter("depth = 0").agg(F.sum("n")).first()[0] or 0
    heavy: dict[int, list[int]] = {}
    # Over a share of total / groups there are at most `groups` rows of a depth.
    for depth, path in counts.filter((F.col("depth") > 0) & (F.col("depth") < window) & (F.col("n") > total / groups)).select(
        "depth", "path"
    ).collect():
        heavy.setdefault(depth, []).append(path)
    return {d: np.sort(np.array(p, np.int64).view(np.uint64)) for d, p in heavy.items()}, groups


# Leaves and subtrees ----------------------------------------------------------------------------------------

LEAVES = "bin int, known boolean, docs int, place binary, node binary"


def pack(ids: np.ndarray, keys: np.ndarray, at: np.ndarray) -> tuple[int, bytes]:
    """Places in few bytes: document by document, ascending in each."""
    head = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))))
    counts = np.diff(np.concatenate((head, [len(at)]))).astype(np.uint32)
    steps_ = np.diff(at.astype(np.int64), prepend=0)
    steps_[head] = at[head]
    data = b"".join((ids[head].tobytes(), keys[head].tobytes(), counts.tobytes(), steps_.astype(np.uint32).tobytes()))
    return len(head), zstandard.compress(data, 1)


def unpack(docs: int, place: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id and key of the document of each place, and the place."""
    data = zstandard.decompress(place)
    ids, keys = np.frombuffer(data, np.int64, 2 * docs).reshape(2, docs)
    counts = np.frombuffer(data, np.uint32, docs, 16 * docs)
    steps_ = np.frombuffer(data, np.uint32, offset=20 * docs).astype(np.int64)
    sums, head = np.cumsum(steps_), np.cumsum(counts) - counts
    at = sums - np.repeat(sums[head] - steps_[head], counts)
    return np.repeat(ids, counts), np.repeat(keys, counts), at.astype(np.uint32)


def by_group(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each group with its members, which stay in order."""
    order = np.argsort(group, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(group) else ():
        yield int(group[part[0]]), part


def record(rows: list[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))


def _leaves(documents: DataFrame, window: int, heavy: dict[int, np.ndarray], groups: int) -> DataFrame:
    """Leaves dealt out by the prefixes: the earliest of each node of a block, and those known to be repeats."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, window):
            at = block.starts
            group, open_ = np.zeros(len(at), np.uint64), np.arange(len(at))
            node = None
            for depth, path in paths(block.words, window):
                if depth == window:
                    node = path[at]
                if len(open_):
                    here = path[at[open_]]
                    group[open_] = here
                    open_ = open_[np.isin(here, heavy[depth])] if depth in heavy else open_[:0]
            order = np.argsort(node, kind="stable")
            first = np.ones(len(at), bool)
            first[order[1:]] = node[order[1:]] != node[order[:-1]]
            slot = np.searchsorted(block.base, at, side="right") - 1
            ids, keys, place = block.ids[slot], block.keys[slot], at - block.base[slot]
            early, later = np.flatnonzero(first), np.flatnonzero(~first)
            bins = _join(group[early], group[early]) % np.uint64(groups)
            rows = [
                (b, False, *pack(ids[x], keys[x], place[x]), node[x].tobytes()) for b, part in by_group(bins) for x in [early[part]]
            ]
            if len(later):
                rows.append((int(keys[later[0]] % groups), True, *pack(ids[later], keys[later], place[later]), b""))
            yield record(rows, bin=pa.int32(), known=pa.bool_(), docs=pa.int32(), place=pa.binary(), node=pa.binary())

    return documents.mapInArrow(deal, LEAVES)


def repeated_leaves(node: np.ndarray, ids: np.ndarray, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Indexes of the leaves that share a node with an earlier one; a leaf given twice is no repeat of itself."""
    order = np.argsort(node)
    same = node[order[1:]] == node[order[:-1]]
    inner = np.zeros(len(node), bool)
    inner[order[1:][same]] = inner[order[:-1][same]] = True
    inner = np.nonzero(inner)[0]
    inner = inner[np.lexsort((at[inner], keys[inner], ids[inner], node[inner]))]
    if not len(inner):
        return inner
    head = np.concatenate(([0], np.nonzero(np.diff(node[inner]))[0] + 1))
    lead = np.repeat(inner[head], np.diff(np.concatenate((head, [len(inner)]))))
    return inner[(ids[inner] != ids[lead]) | (keys[inner] != keys[lead]) | (at[inner] != at[lead])]


def _subtrees(leaves: DataFrame, groups: int) -> DataFrame:
    """(bin, docs, place): the repeated leaves of each group, dealt out by their documents."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, known = [], []
        for batch in batches:
            for is_known, docs, place, node in zip(*(batch[c].to_pylist() for c in ("known", "docs", "place", "node")), strict=True):
                (known if is_known else fresh).append((*unpack(docs, place), np.frombuffer(node, np.uint64)))
        found = [x[:3] for x in known]
        if fresh:
            ids, keys, at, node = (np.concatenate(x) for x in zip(*fresh, strict=True))
            again = repeated_leaves(node, ids, keys, at)
            found.append((ids[again], keys[again], at[again]))
        if found:
            ids, keys, at = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((at, keys, ids))
            ids, keys, at = ids[order], keys[order], at[order]
            home = _join(ids.view(np.uint64), keys.view(np.uint64)) % np.uint64(groups)
            yield record([(b, *pack(ids[x], keys[x], at[x])) for b, x in by_group(home)], bin=pa.int32(), docs=pa.int32(), place=pa.binary())

    return leaves.repartition(groups, "bin").mapInArrow(merge, "bin int, docs int, place binary")


def _gathered(repeats: DataFrame, groups: int) -> DataFrame:
    """(place, key, starts), one row for each document with repeated leaves: `starts` holds ascending 32-bit places."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [unpack(d, p) for batch in batches for d, p in zip(batch["docs"].to_pylist(), batch["place"].to_pylist(), strict=True)]
        if not found:
            return
        ids, keys, at = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        order = np.lexsort((at, keys, ids))
        ids, keys, at = ids[order], keys[order], at[order]
        head = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))))
        ends = np.concatenate((head, [len(at)])) * 4
        data = memoryview(at.tobytes())
        starts = pa.array([data[a:z] for a, z in pairwise(ends.tolist())], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(ids[head]), pa.array(keys[head]), starts], names=["place", "key", "starts"])

    return repeats.repartition(groups, "bin").mapInArrow(gather, "place long, key long, starts binary")


# Documents --------------------------------------------------------------------------------------------------


def cover(n: int, starts: bytes, window: int) -> np.ndarray:
    """Which of `n` words a window at one of the packed `starts` covers."""
    at = np.unique(np.frombuffer(starts, np.uint32)).astype(np.int64)
    edge = np.zeros(n + 1, np.int32)
    edge[at] += 1
    edge[at + window] -= 1
    return np.cumsum(edge[:n]) > 0


@F.pandas_udf(T.BinaryType())
def _shrunk(texts: pd.Series) -> pd.Series:
    """Texts as compressed bytes, since they move once."""
    pack = zstandard.ZstdCompressor(level=1).compress
    return texts.map(lambda x: None if x is None else pack(x.encode("utf-8", "surrogatepass")))


def remove_repeats(documents: DataFrame, window: int = WINDOW, group_leaves: int = GROUP_LEAVES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, spans) of every row: words in windows seen earlier are taken out.

    A window of `window` words is repeated if the same words also start earlier: in a document of a smaller id, or earlier
    in the same one. `kept` is the words that stay, joined by blanks; `spans` the removed runs (start, n_words). Windows are
    judged on the input.

    A null or empty text has no words, and a text of fewer words than a window keeps them all. A null id counts as the
    largest long. Rows of the same id and text are one document and have the same result; different texts of one id go by a
    64-bit hash. An empty table gives none. Only `doc_id` and `text` are read, so other columns are not carried and can't
    clash. `window` is at least 1.
    """
    docs = documents.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("place"), F.xxhash64("text").alias("key"), "text"
    )
    source = docs.select("place", "key", F.col("text").cast("binary").alias("text"))
    heavy, groups = split_prefixes(source, window, group_leaves)
    gathered = _gathered(_subtrees(_leaves(source, window, heavy, groups), groups), groups)

    @F.pandas_udf("n_words long, n_removed long, kept string, spans array<struct<start: int, n_words: int>>")
    def cleaned(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for packed, found in zip(texts, starts, strict=True):
            data = b"" if packed is None else zstandard.decompress(packed)
            words = data.split()
            if found is None:
                out.append((len(words), 0, b" ".join(words).decode("utf-8", "surrogatepass"), []))
                continue
            gone = cover(len(words), found, window)
            cuts = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
            kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
            spans = [{"start": int(a), "n_words": int(b - a)} for a, b in cuts.reshape(-1, 2)]
            out.append((len(words), int(gone.sum()), kept.decode("utf-8", "surrogatepass"), spans))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept", "spans"])

    moved = docs.select("doc_id", "place", "key", _shrunk("text").alias("text"))
    return moved.join(gathered, ["place", "key"], "left").select("doc_id", cleaned("text", "starts").alias("c")).select("doc_id", "c.*")


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, how many of them earlier 20-word windows repeat, and a digest of the rest.

    Nulls, empty texts, ties, repeated rows and empty tables as in `remove_repeats`; a repeated row is returned as often.
    """
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = f"""with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
starts as (select doc_id, unnest(range(1, len(w) - {WINDOW - 2})) as i, w from docs where len(w) >= {WINDOW}),
windows as (select doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') as v from starts),
again as (select doc_id, i from windows qualify row_number() over (partition by v order by doc_id, i) > 1),
gone as (select distinct doc_id, i + k as i from again, range(0, {WINDOW}) r(k)),
words as (select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from docs),
kept as (select doc_id, string_agg(word, ' ' order by i) as t, count(*) as n from words anti join gone using (doc_id, i) group by 1)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from docs left join kept using (doc_id)"""
