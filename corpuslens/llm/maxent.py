"""Language model scores: a hashed maximum-entropy model of n-gram and skip features with a class-factored softmax.

P(word | text before) = P(class | features) * P(word | class, features). Frequent words share `HEAD` classes of `MEMBERS`
words each, and both factors see the words before; all others belong to a class by their ending, in which
their probability is their smoothed share of the class. Every distribution sums to one, an unknown word included.

The features of a place are the word before (n-gram), the word before that (skip) and both. Gradient rounds fit a small model
with words cut to a few hundred ids; from it the features of whole words, hashed one by one, lead on: the word before that and
both act on the class, the word before on the word in its class. There is one feature for each hashed context and outcome that the
learning texts hold, rare words included, and their number grows with the texts. Each set maximises its likelihood less
`pull` times the relative entropy from the model before it, which has a closed form: a feature seen n times among N, of an
outcome that had the probability q, gets the weight log(1 + n / (pull * q)), and the context's sum is 1 + N / pull.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache, reduce
from hashlib import blake2b
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.common import fold, table
from corpuslens.session import cut_lineage

HEAD, MEMBERS, TAIL = 48, 32, 16
CLASSES = HEAD + TAIL
#: Ids of the word before and of the word before that: the start of the text, frequent words, and classes by ending.
FIRST, SECOND = 256, 64
#: Buckets for the hash of both.
PAIRS = 1 << 13
#: Words whose counts travel with the code; all others meet their counts in a join.
KNOWN = 1 << 16
#: How strongly the features of a whole word hold to the model before them: skip, both, n-gram.
PULL_SKIP, PULL_BOTH, PULL_WORD = 20.0, 2.0, 10.0
#: Places of the texts whose features travel together, places of all learning texts for each group that they meet in, and
#: segments of texts that a chunk has at most, whose numbers share 16 bits with two flags.
CHUNK, GROUP, SEGMENTS = 1 << 19, 1 << 20, 1 << 14
#: Slots from here on take a byte more in an encoded text.
OVER = (1 << 16) - 1
#: Blocks of the two tables of counts.
PARTS = {"c": 64, "m": 16}
#: Stands for the end of a text; no word holds white space.
END = b"\n"
FOLDS = 10


def ending(word: bytes) -> int:
    return crc32(word[-3:]) % TAIL


def digests(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([blake2b(w, digest_size=8).digest() for w in words]), "<u8")


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64 bits of two hashes, in this order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_blocks(text: str | None, size: int = 1 << 22) -> Iterator[list[bytes]]:
    """Lower-cased words of a text in blocks of bounded size, the end mark last."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    at = 0
    while len(data) - at > size:
        cut = max(data.rfind(gap, at, at + size) for gap in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        if cut <= at:
            break
        yield data[at:cut].split()
        at = cut
    yield [*data[at:].split(), END]


def word_counts(documents: DataFrame, distinct: int = 1 << 18) -> DataFrame:
    """(word, c): how often each word, and the end mark, occurs; tasks add up first."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: Counter[bytes] = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(sums.keys()), "c": list(sums.values())})
            sums.clear()
            return out

        for b in batches:
            for text in b["text"]:
                for words in word_blocks(text):
                    sums.update(words)
                    if len(sums) > distinct:
                        yield flush()
        yield flush()

    return documents.select("text").mapInPandas(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Slots of words: 0.. for the known ones, most frequent first, then one per ending."""

    def __init__(self, words: list[bytes], counts: list[int]):
        words, counts = list(words), list(counts)
        if END in words:  # the end of a text is always in the head
            i = words.index(END)
            words.insert(0, words.pop(i))
            counts.insert(0, counts.pop(i))
        n = len(words)
        head = min(n, HEAD * MEMBERS)

        class Slots(dict):
            def __missing__(self, word: bytes) -> int:
                return n + ending(word)

        self.slots = Slots(zip(words, range(n), strict=True))
        self.known = n
        ends = np.array([ending(w) for w in words] + list(range(TAIL)), np.int64)
        slot = np.arange(n + TAIL)
        self.head = slot < head
        self.place = np.where(self.head, slot, 0)  # class * MEMBERS + member
        self.class_ = np.where(self.head, slot // MEMBERS, HEAD + ends)
        self.first = np.where(slot < min(n, FIRST - TAIL - 1), 1 + slot, FIRST - TAIL + ends)
        self.second = np.where(slot < min(n, SECOND - TAIL - 1), 1 + slot, SECOND - TAIL + ends)
        self.log_count = np.append(np.log10(np.array(counts, np.float64) + 0.1), np.zeros(TAIL))
        self.words = words

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.append(digests(self.words), np.zeros(TAIL, np.uint64))

    @cached_property
    def _known(self) -> pa.Array:
        return pa.array(self.words, pa.large_binary())

    def find(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Slots of words, and the words that aren't known."""
        found = pc.index_in(pa.array(words, pa.large_binary()), value_set=self._known)
        slots = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        far = np.nonzero(slots < 0)[0]
        strange = [words[i] for i in far.tolist()]
        slots[far] = [self.known + ending(w) for w in strange]
        return slots, strange

    def read(self, text: str | None) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        """Slots and contexts (first * SECOND + second) block by block, with the words themselves."""
        p1 = p2 = -1
        for words in word_blocks(text):
            slots, _ = self.find(words)
            if not len(slots):
                continue
            before = np.concatenate(([p2, p1], slots))
            one, two = before[1:-1], before[:-2]
            context = np.where(one < 0, 0, self.first[one]) * SECOND + np.where(two < 0, 0, self.second[two])
            p2, p1 = before[-2:]
            yield slots, context, words


@lru_cache(maxsize=1)
def vocabulary_of(tables: Broadcast) -> Vocabulary:
    """The words of `tables`, read once a worker."""
    return Vocabulary(*tables.value[0])


class Model(NamedTuple):
    """The arrays of `train`, and the encoded learning texts, whose whole words are counted where texts are scored."""

    tables: Broadcast
    learning: DataFrame

    @property
    def value(self):
        return self.tables.value


ROW = "_row long, doc_id string, n_tokens long, known long, base double, words array<binary>, times array<long>"
TEXTS = "chunk long, ids binary, lengths binary, flags binary, before binary, before_hashes binary, codes binary, over binary, hashes binary"
LEARNS, WANTED = 2, 1


def encode(documents: DataFrame, vocabulary: Broadcast, learns: Column, wanted: bool = True) -> DataFrame:
    """Texts as slots, read once for all that follows: a row of `ROW` for every document (chunk -1), and rows of `TEXTS` with
    about `CHUNK` places each: row numbers, lengths, flags and the two words before of each segment of a text, then two bytes a place, and
    the hashes of the words that aren't known. A long text is cut into segments at its blocks."""
    chunk, most = CHUNK, SEGMENTS
    blank = dict.fromkeys(x.split()[0] for x in (ROW + ", " + TEXTS).split(", "))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = Vocabulary(*vocabulary.value)
        number = TaskContext.get().partitionId() << 32
        segments: list[tuple] = []
        held: list[np.ndarray] = []
        rare: list[bytes] = []

        def flush() -> dict:
            nonlocal number
            ids, lengths, flags, before, before_hashes = zip(*segments, strict=True)
            slots = np.concatenate(held)
            out = blank | {
                "_row": -1, "n_tokens": 0, "known": 0, "base": 0.0, "chunk": number,
                "ids": np.array(ids, np.int64).tobytes(), "lengths": np.array(lengths, np.int32).tobytes(),
                "flags": np.array(flags, np.uint8).tobytes(), "before": np.array(before, np.int32).tobytes(),
                "before_hashes": np.array(before_hashes, np.uint64).tobytes(), "codes": np.minimum(slots, OVER).astype(np.uint16).tobytes(),
                "over": (slots[slots >= OVER] - OVER).astype(np.uint8).tobytes(), "hashes": digests(rare).tobytes(),
            }
            number += 1
            for x in (segments, held, rare):
                x.clear()
            return out

        def settle(blocks: list[tuple]) -> Iterator[dict]:
            """Rows of the texts that end in these blocks of words, which are looked up together, and of full chunks."""
            nonlocal text, size
            lengths = np.array([len(words) for _, _, _, words in blocks])
            slots, strange = v.find([w for _, _, _, words in blocks for w in words])
            starts = np.cumsum(lengths) - lengths
            logs = np.add.reduceat(v.log_count[slots], starts).tolist()
            fars = np.add.reduceat(slots >= v.known, starts, dtype=np.int64).tolist()
            at = 0
            for (row, doc_id, learning, words), start, log, far in zip(blocks, starts.tolist(), logs, fars, strict=True):
                n, known, base, rest, before, before_hashes = text or (0, 0, 0.0, Counter(), (-1, -1), (0, 0))
                mine, own, at = slots[start : start + len(words)], strange[at : at + far], at + far
                rest.update(own)
                rare.extend(own)
                segments.append((row, len(words), LEARNS * bool(learning) + WANTED * wanted, before, before_hashes))
                held.append(mine)
                size += len(words)
                n, known, base = n + len(words), known + len(words) - far, base + log
                if words[-1] != END:  # the text goes on
                    before = (*before, *mine[-2:].tolist())[-2:]
                    before_hashes = (*before_hashes, *digests(words[-2:]).tolist())[-2:]
                    text = n, known, base, rest, before, before_hashes
                else:
                    text = None
                    if wanted:
                        yield blank | {
                            "_row": row, "doc_id": doc_id, "n_tokens": n, "known": known, "base": base, "words": list(rest.keys()),
                            "times": list(rest.values()), "chunk": -1,
                        }
                if size >= chunk or len(segments) >= most:  # also within a text
                    yield flush()
                    size = 0

        text, size = None, 0
        blocks, total = [], 0
        for b in batches:
            for row, doc_id, whole, learning in zip(b["_row"], b["doc_id"], b["text"], b["_learns"], strict=True):
                for words in word_blocks(whole):
                    if words:
                        blocks.append((row, doc_id, learning, words))
                        total += len(words)
                    if total >= 1 << 17:
                        yield pd.DataFrame(settle(blocks), columns=list(blank))
                        blocks, total = [], 0
        if blocks:
            yield pd.DataFrame(settle(blocks), columns=list(blank))
        if segments:
            yield pd.DataFrame([flush()], columns=list(blank))

    return cut_lineage(documents.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("string").alias("doc_id"), "text", learns.alias("_learns"),
    ).mapInPandas(read, ROW + ", " + TEXTS), free=True)


def chunks(encoded: DataFrame) -> DataFrame:
    return encoded.filter("chunk >= 0").select(*(x.split()[0] for x in TEXTS.split(", ")))


class Places:
    """The places of an encoded chunk: slots, contexts, and hashes of the words, of the words before and of the words before that."""

    def __init__(self, v: Vocabulary, row):
        self.lengths = np.frombuffer(row.lengths, np.int32)
        self.flags = np.frombuffer(row.flags, np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.slots = np.frombuffer(row.codes, np.uint16).astype(np.int64)
        self.slots[self.slots == OVER] += np.frombuffer(row.over, np.uint8)
        self.row, self.v = row, v
        first, second = self._before(self.slots, np.frombuffer(row.before, np.int32))
        # an index of -1, the start of a text, finds the zero at the end
        self.context = np.append(v.first, 0)[first] * SECOND + np.append(v.second, 0)[second]

    def _before(self, x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        two, one = known.reshape(-1, 2).T
        first, second = np.empty_like(x), np.empty_like(x)
        first[1:], second[2:] = x[:-1], x[:-2]
        longer = self.lengths > 1
        first[self.starts], second[self.starts], second[self.starts[longer] + 1] = one, two, one[longer]
        return first, second

    @cached_property
    def hashes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = self.v.hashes[self.slots]
        own[self.slots >= self.v.known] = np.frombuffer(self.row.hashes, np.uint64)
        return own, *self._before(own, np.frombuffer(self.row.before_hashes, np.uint64))


def context_counts(encoded: DataFrame, vocabulary) -> DataFrame:
    """(kind, block, sums): counts over all learning texts of (context, class), kind c, and of (word before, head word), kind m, in
    80 blocks of fixed size. Tasks send blocks of their tables, which are summed in two steps, so that no task meets
    all others' at once."""
    shapes = {"c": (FIRST * SECOND, CLASSES), "m": (FIRST, HEAD * MEMBERS)}
    parts = PARTS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = Vocabulary(*vocabulary.value)
        sums = {k: np.zeros(a * b, np.int64) for k, (a, b) in shapes.items()}
        for b in batches:
            for row in b.itertuples():
                p = Places(v, row)
                learnt = np.repeat(p.flags & LEARNS > 0, p.lengths)
                slots, context = p.slots[learnt], p.context[learnt]
                sums["c"] += np.bincount(context * CLASSES + v.class_[slots], minlength=len(sums["c"]))
                head = v.head[slots]
                sums["m"] += np.bincount(context[head] // SECOND * (HEAD * MEMBERS) + v.place[slots[head]], minlength=len(sums["m"]))
        rows = [(k, i, part.tobytes()) for k in sums for i, part in enumerate(np.split(sums[k], parts[k])) if part.any()]
        yield pd.DataFrame(rows, columns=["kind", "block", "sums"])

    def total(group: pd.DataFrame) -> pd.DataFrame:
        out = sum(np.frombuffer(x, np.int64) for x in group["sums"])
        return group.iloc[:1].assign(sums=[out.tobytes()])

    schema = "kind string, block int, sums binary"
    some = chunks(encoded).mapInPandas(count, schema).withColumn("part", F.spark_partition_id() % 16)
    halfway = some.groupBy("kind", "block", "part").applyInPandas(total, schema + ", part int")
    return cut_lineage(halfway.groupBy("kind", "block").applyInPandas(total, schema + ", part int").drop("part"), free=True)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def pair_bucket(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return ((first * 0x9E3779B1 + second * 0x85EBCA77) % (1 << 32) >> 7) % PAIRS


def fit(
    blocks: DataFrame, kind: str, features: np.ndarray, n_features: int, columns: int, groups: int, rounds: int, ridge: float = 2.0,
) -> np.ndarray:
    """Weights of the features (the last row is the bias) for `groups` softmaxes that share the columns of the counts.

    `features` has the features of each row of counts. Each round is one Spark job: tasks take their blocks of counts,
    form the expected counts under the present weights and send back sums by feature. Steps are scaled by how
    often a feature was seen, which bounds the curvature, and carry momentum.
    """
    spark, members, active = blocks.sparkSession, columns // groups, features.shape[1] + 1
    rows = blocks.filter(F.col("kind") == kind).select("block", "sums").coalesce(4)
    counts = np.zeros((len(features), columns), np.int64)
    for r in rows.collect():  # the whole table, of fixed size
        part = np.frombuffer(r["sums"], np.int64).reshape(-1, columns)
        counts[r["block"] * len(part) : (r["block"] + 1) * len(part)] = part
    seen = np.zeros((n_features + 1, groups))
    per_group = counts.reshape(len(counts), groups, members).sum(axis=2)
    for k in range(features.shape[1]):
        np.add.at(seen, features[:, k], per_group)
    seen[-1] = per_group.sum(axis=0)
    step = np.repeat(1 / (0.5 * active * seen + ridge), members, axis=1).astype(np.float32)
    share = counts.sum(axis=0).reshape(groups, members) + 0.5
    del counts, per_group
    weights = np.zeros((n_features + 1, columns), np.float32)
    weights[-1] = np.log(share / share.sum(axis=1, keepdims=True)).ravel()
    start, ahead, momentum = weights.copy(), weights.copy(), 1.0

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(ahead)

        def slope(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            out = np.zeros((n_features + 1, columns))
            for b in batches:
                for block, sums in zip(b["block"], b["sums"], strict=True):
                    n = np.frombuffer(sums, np.int64).reshape(-1, groups, members).astype(np.float64)
                    f = features[block * len(n) : (block + 1) * len(n)]
                    z = shared.value[f].sum(axis=1) + shared.value[-1]
                    miss = (n - n.sum(axis=2, keepdims=True) * np.exp(log_softmax(z.reshape(n.shape)))).reshape(len(n), columns)
                    for k in range(f.shape[1]):
                        np.add.at(out, f[:, k], miss)
                    out[-1] += miss.sum(axis=0)
            yield pd.DataFrame({"sums": [out.astype(np.float32).tobytes()]})

        sums = rows.mapInPandas(slope, "sums binary").collect()  # four tables of the weights' size
        gradient = sum(np.frombuffer(r["sums"], np.float32).reshape(weights.shape) for r in sums) - ridge * (ahead - start)
        fresh, next_ = ahead + step * gradient, (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead, weights, momentum = (fresh + (momentum - 1) / next_ * (fresh - weights)).astype(np.float32), fresh, next_
        shared.destroy()
    return weights.astype(np.float64)


def known_words(counts: DataFrame) -> DataFrame:
    """The most frequent words, most frequent first: as many whole steps of frequency, sixteen to a doubling, as hold
    `KNOWN` words at most; and the end mark. Only the sizes of the steps reach the driver, never all words."""
    step = F.floor(16 * F.log2("c"))
    steps = counts.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect()
    least, total = math.inf, 0
    for r in steps:
        total += r["count"]
        if total > KNOWN:
            break
        least = r["s"]
    return counts.filter((step >= F.lit(float(least))) | (F.col("word") == F.lit(END))).orderBy(F.desc("c"), "word")


def share_words(counts: DataFrame) -> Broadcast:
    known = {bytes(r["word"]): r["c"] for r in known_words(counts).collect()}  # KNOWN rows and the end mark at most
    return counts.sparkSession.sparkContext.broadcast((list(known.keys()), list(known.values())))


def train(documents: DataFrame, counts: DataFrame, rounds: int = 12) -> Model:
    """The model of `documents`, whose word counts are `counts`."""
    vocabulary = share_words(counts)
    rows = documents.select(F.lit(None).cast("string").alias("doc_id"), "text")
    return train_encoded(encode(rows, vocabulary, F.lit(True), wanted=False), vocabulary, counts, rounds)


def train_encoded(encoded: DataFrame, vocabulary: Broadcast, counts: DataFrame, rounds: int = 12) -> Model:
    """The encoded texts and the model with cut words as arrays: known words and counts, log10 P(class | context), log10 P(head word | class, word before), and
    log10 of the smoothed size of each class by ending. `counts` are the word counts of the learning texts."""
    spark = encoded.sparkSession
    blocks = context_counts(encoded, vocabulary)
    first, second = np.divmod(np.arange(FIRST * SECOND), SECOND)
    shape = np.stack([first, FIRST + second, FIRST + SECOND + pair_bucket(first, second)], axis=1)
    w = fit(blocks, "c", shape, FIRST + SECOND + PAIRS, CLASSES, 1, rounds)
    by_class = log_softmax(sum(w[shape[:, k]] for k in range(3)) + w[-1])
    u = fit(blocks, "m", np.arange(FIRST)[:, None], FIRST, HEAD * MEMBERS, HEAD, rounds)
    by_member = log_softmax((u[:-1] + u[-1]).reshape(FIRST, HEAD, MEMBERS))
    v = Vocabulary(*vocabulary.value)
    real = np.zeros(HEAD * MEMBERS, bool)
    real[v.place[v.head]] = True
    real = real.reshape(HEAD, MEMBERS)
    by_member = np.where(real, by_member, -np.inf)  # places without a word
    by_member -= np.where(real.any(axis=1, keepdims=True), _log_sum(by_member), 0)

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, out = Vocabulary(*vocabulary.value), np.zeros((TAIL, 2))
        for b in batches:
            slot = np.array([v.slots[bytes(w)] for w in b["word"]], np.int64)
            far = ~v.head[slot] if len(slot) else np.zeros(0, bool)
            at = v.class_[slot[far]] - HEAD
            out[:, 0] += np.bincount(at, b["c"].to_numpy()[far], TAIL)
            out[:, 1] += np.bincount(at, minlength=TAIL)
        yield pd.DataFrame({"k": range(TAIL), "n": out[:, 0], "v": out[:, 1]})

    by_end = {r["k"]: r for r in counts.mapInPandas(sizes, "k int, n double, v double").groupBy("k").agg(
        F.sum("n").alias("n"), F.sum("v").alias("v")
    ).collect()}
    size = np.array([(by_end[k]["n"] + 0.1 * (by_end[k]["v"] + 1)) if k in by_end else 0.1 for k in range(TAIL)])
    ten = math.log(10)
    return Model(spark.sparkContext.broadcast((
        vocabulary.value, (by_class / ten).astype(np.float32), (by_member.reshape(FIRST, -1) / ten).astype(np.float32), np.log10(size),
    )), encoded)


def _log_sum(x: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x).sum(axis=-1, keepdims=True))


KINDS = ("both", "word", "rare")


def feature_keys(kind: str, v: Vocabulary, p: Places) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Keys of 64 bits of the features of places, what the cut model needs to know there, and the places, if not all.

    both: word before that, word before, class; the lowest bit of the first part tells that the word before that has features of
    its own in the cut model, and that part then holds both words. The context is passed on.
    word: word before and class, then the known word, or 0 for a rarer one. The id of the word before is passed on.
    rare: a word that isn't known, then the word before. Its ending is passed on.
    """
    u, none = np.uint64, np.uint64(0)
    hashes, first, second = p.hashes
    if kind == "both":
        both, own = mixed(first, second), p.context % SECOND < SECOND - TAIL
        part = np.where(own, both, mixed(second, none)) >> u(31) << u(31) | own.astype(np.uint64) << u(30)
        keys = part | (both & u((1 << 24) - 1)) << u(6) | v.class_[p.slots].astype(np.uint64)
        return keys, p.context.astype(np.uint16), None
    if kind == "word":
        known = np.where(p.slots >= v.known, 0, p.slots + 1).astype(np.uint64)
        keys = mixed(first, v.class_[p.slots].astype(np.uint64)) >> u(18) << u(18) | known
        return keys, (p.context // SECOND).astype(np.uint8), None
    far = np.nonzero(p.slots >= v.known)[0]
    keys = mixed(hashes[far], none) >> u(28) << u(28) | mixed(first[far], none) >> u(36)
    return keys, (v.class_[p.slots[far]] - HEAD).astype(np.uint8), far


def pack(x: np.ndarray) -> bytes:
    """Numbers byte by byte, compressed: all first bytes, all second ones and so on, of which the upper ones vary little."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T)
    return len(x).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, dtype: type) -> np.ndarray:
    n, size = int.from_bytes(data[:4], "little"), np.dtype(dtype).itemsize
    planes = pa.decompress(memoryview(data)[4:], n * size, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def terms(kind: str, keys: np.ndarray, n: np.ndarray, given: np.ndarray, tables: Broadcast) -> np.ndarray:
    """What each key adds to the log10 probability of a text; `n` is how often the learning texts hold it. `keys` are all that
    begin alike, in order, so that sums over them are counts of contexts."""
    _, by_class, by_member, size = tables.value
    u = np.uint64

    def within(context: np.ndarray, in_order: bool = True) -> np.ndarray:
        if in_order:
            at = np.cumsum(context[1:] != context[:-1])
            at = np.concatenate((np.zeros(min(1, len(context)), at.dtype), at))
        else:
            at = np.unique(context, return_inverse=True)[1]
        return np.bincount(at, n, len(context))[at]

    if kind == "both":
        class_ = keys & u(63)
        q = np.power(10.0, by_class[given, class_].astype(np.float64))
        skip = (within(keys >> u(30) << u(6) | class_, False) + PULL_SKIP * q) / (within(keys >> u(30)) + PULL_SKIP)
        q = np.where(keys >> u(30) & u(1) == 1, q, skip)
        return np.log10((n + PULL_BOTH * q) / (within(keys >> u(6)) + PULL_BOTH))
    if kind == "word":
        v, slot = vocabulary_of(tables), (keys & u((1 << 18) - 1)).astype(np.int64) - 1
        known = slot >= 0
        slot = np.maximum(slot, 0)
        tail = v.log_count[slot] - size[np.maximum(v.class_[slot] - HEAD, 0)]
        q = np.power(10.0, np.where(v.head[slot], by_member[given, v.place[slot]], tail)).astype(np.float32)
        return np.log10(np.where(known, n + PULL_WORD * q.astype(np.float64), 1)) - np.log10(within(keys >> u(18)) + PULL_WORD)
    return np.log10(n + PULL_WORD * (within(keys >> u(28)) + 0.1) / np.power(10.0, size[given]))


GIVEN = {"both": np.uint16, "word": np.uint8, "rare": np.uint8}


def feature_sums(texts: DataFrame, tables: Broadcast, kind: str, groups: int) -> DataFrame:
    """(_row, sum): what the features of this kind add to a segment of a wanted text, from the chunks of `encode`.

    Tasks sort the features of a chunk, each once with the segments that hold it, and deal them out by ranges of keys. All that
    share a context meet in one group, which counts them and answers each chunk by sums; a chunk adds up its answers.
    """
    slice_, most = CHUNK, SEGMENTS

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v, edges = vocabulary_of(tables), np.array([(g << 64) // groups for g in range(1, groups)], np.uint64)
        # a context never spans two ranges: its keys agree in their upper 34 bits at least
        edges = edges >> np.uint64(30) << np.uint64(30)
        for b in batches:
            for chunk in b.itertuples():
                p, out = Places(v, chunk), []
                number = np.arange(len(p.lengths), dtype=np.uint16) | p.flags.astype(np.uint16) << np.uint16(14)
                number = np.repeat(number, p.lengths)
                keys, given, at = feature_keys(kind, v, p)
                order = np.argsort(keys)
                keys, given, rows = keys[order], given[order], number[order if at is None else at[order]]
                new = np.ones(len(keys), bool)
                new[1:] = keys[1:] != keys[:-1]
                at = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                for g in range(groups):
                    x, y = at[g], at[g + 1]
                    if x < y:
                        some = new[x:y]
                        out.append((
                            g, chunk.chunk, pack(np.diff(keys[x:y][some], prepend=np.uint64(0))), pack(given[x:y][some]),
                            np.packbits(some).tobytes(), pack(rows[x:y]),
                        ))
                yield pd.DataFrame(out, columns=["part", "chunk", "keys", "given", "new", "rows"])

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack(x, np.uint64).cumsum(dtype=np.uint64) for x in group["keys"]]
        rows = [unpack(x, np.uint16) for x in group["rows"]]
        times, learnt = [], []
        for new, x in zip(group["new"], rows, strict=True):
            begins = np.nonzero(np.unpackbits(np.frombuffer(new, np.uint8), count=len(x)))[0]
            times.append(np.diff(begins, append=len(x)))
            learnt.append(np.add.reduceat(x >> 15, begins, dtype=np.int32))
        ends = np.cumsum([len(k) for k in keys])
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        every = keys[order]
        new = np.ones(len(every), bool)
        new[1:] = every[1:] != every[:-1]
        at = np.empty(len(every), np.int64)
        at[order] = np.cumsum(new) - 1
        every = every[new]
        given = np.concatenate([unpack(x, GIVEN[kind]) for x in group["given"]])[order[new]]
        del keys, order, new
        gains = terms(kind, every, np.bincount(at, np.concatenate(learnt), len(every)), given, tables)
        out, number, begin = [], group["chunk"].to_numpy(), 0
        while begin < len(rows):  # a feature may stand at many places: some pieces at a time
            end, held = begin, 0
            while end < len(rows) and (end == begin or held + len(rows[end]) <= slice_):
                held += len(rows[end])
                end += 1
            mine = gains[at[ends[begin] - len(times[begin]) : ends[end - 1]]]
            mine = np.repeat(mine, np.concatenate(times[begin:end]))
            where = np.concatenate(rows[begin:end])
            piece = np.repeat(np.arange(end - begin), [len(x) for x in rows[begin:end]])
            asked = where >> 14 & WANTED == 1
            where = (piece * most + (where & (most - 1)))[asked]
            if (end - begin) * most <= 8 * len(where):
                places = np.nonzero(np.bincount(where))[0]
                sums = np.bincount(where, mine[asked])[places]
            else:
                places, where = np.unique(where, return_inverse=True)
                sums = np.bincount(where, mine[asked], len(places))
            at_piece = np.searchsorted(places, np.arange(end - begin + 1) * most).tolist()
            places = (places & (most - 1)).astype(np.uint16)
            for i, (x, y) in enumerate(zip(at_piece, at_piece[1:], strict=False)):
                if x < y:
                    out.append((number[begin + i], None, places[x:y].tobytes(), sums[x:y].tobytes()))
            begin = end
        return pd.DataFrame(out, columns=["chunk", "ids", "places", "sums"])

    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        ids = np.frombuffer(next(x for x in group["ids"] if x is not None), np.int64)
        out = np.zeros(len(ids))
        for places, sums in zip(group["places"], group["sums"], strict=True):
            if places is not None:
                out[np.frombuffer(places, np.uint16)] += np.frombuffer(sums, np.float64)
        return pd.DataFrame({"_row": ids, "sum": out})

    dealt = texts.mapInPandas(deal, "part int, chunk long, keys binary, given binary, new binary, rows binary")
    answers = dealt.groupBy("part").applyInPandas(answer, "chunk long, ids binary, places binary, sums binary")
    none = F.lit(None).cast("binary")
    asks = texts.filter("_wanted").select("chunk", "ids", none.alias("places"), none.alias("sums"))
    return answers.unionAll(asks).groupBy("chunk").applyInPandas(add_up, "_row long, sum double")


def score(documents: DataFrame, model: Model, counts: DataFrame, learns: Column | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The features of whole words are counted beside those that are asked for; `learns` tells which of the
    documents are the model's learning texts, which are then read once for both. A null text counts as empty: its
    end is its one token. Repeated rows and ids are scored each; an empty table gives none; other columns are not carried.
    """
    vocabulary = documents.sparkSession.sparkContext.broadcast(model.value[0])
    encoded = encode(documents, vocabulary, F.lit(False) if learns is None else F.coalesce(learns, F.lit(False)))
    return score_encoded(encoded, model, counts, None if learns is not None else model.learning)


def score_encoded(encoded: DataFrame, model: Model, counts: DataFrame, learning: DataFrame | None = None) -> DataFrame:
    """As `score`, of encoded documents and, if those don't hold them, the encoded learning texts.

    Known words were counted where the text was read. Every other word travels to its count, with its number in the
    text, and the sums come back by row.
    """
    rows = encoded.filter("chunk < 0").select(*(x.split()[0] for x in ROW.split(", ")))
    far = rows.filter(F.size("words") > 0).select("_row", F.inline(F.arrays_zip("words", "times")))
    met = far.join(counts.withColumnRenamed("word", "words"), "words", "left").groupBy("_row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("_logs"),
    )
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    unit = math.log10(size["n"] + 0.1 * (size["v"] + 1))
    texts = chunks(encoded).withColumn("_wanted", F.lit(True))
    if learning is not None:
        texts = texts.unionAll(chunks(learning).withColumn("_wanted", F.lit(False)))
    groups = max(16, size["n"] // GROUP)
    # one after the other, each job's shuffle files are gone before the next begins
    sums = [cut_lineage(feature_sums(texts, model.tables, kind, groups), free=True) for kind in KINDS]
    total = reduce(DataFrame.unionAll, sums).groupBy("_row").agg(F.sum("sum").alias("_sum"))
    logs = F.coalesce("_logs", F.lit(0.0))
    scored = rows.drop("words", "times").join(met, "_row", "left").join(total, "_row", "left")
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(size["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * unit).alias("base_score"), F.col("_sum").alias("score"),
    )


def op10_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by a model of nine folds out of ten; nulls, empty and long texts, ties, repeated rows, empty
    tables and clashing names as in `score` and `train`."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    learns = fold(F.col("doc_id"), FOLDS) != 0
    counts = cut_lineage(word_counts(documents.filter(learns)), free=True)
    vocabulary = share_words(counts)
    encoded = encode(documents, vocabulary, learns)
    scored = score_encoded(encoded, train_encoded(encoded, vocabulary, counts), counts)
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), *scored.columns[1:])
