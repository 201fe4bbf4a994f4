"""Repair of the turn structure of conversations by alignment to the grammar `(s?(ua)+)?` of role initials.

Rows are sorted over all conversations and cut where Spark cuts the sort, so a conversation of any length becomes pieces, and
a piece segments of 64 turns. A segment is aligned by Wagner and Fischer's table to each feasible length of the alternating
string that can follow one state of the grammar and lead to another; a length is tried only while its least possible cost is
within the incumbent's, and its table is filled only inside Ukkonen's band for that cost. Alignments of equal cost are
backtraced to their audits, of which the ASCII-least stays. Segments, then pieces, are chained by the states between them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpuslens.llm.common import GAPS, table
from corpuslens.session import cut_lineage

REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {"su", "ua", "au"}
SEGMENT = 64
NAMES = {"u": "user", "a": "assistant"}
#: (string, least length, step) of the targets that lead from one state of the grammar to another; "0" is its start.
#: U is "uaua...", A "auau..." and S "suaua...".
ROUTES = {
    ("0", "0"): [("U", 0, 0)], ("0", "s"): [("S", 1, 0)], ("0", "u"): [("U", 1, 2), ("S", 2, 2)],
    ("0", "a"): [("U", 2, 2), ("S", 3, 2)], ("s", "s"): [("U", 0, 0)], ("s", "u"): [("U", 1, 2)],
    ("s", "a"): [("U", 2, 2)], ("u", "u"): [("A", 0, 2)], ("u", "a"): [("A", 1, 2)],
    ("a", "a"): [("U", 0, 2)], ("a", "u"): [("U", 1, 2)],
}
INFINITE = 1 << 60

Turn = tuple[str, bool, bool]  # initial, must be deleted, truncated
Best = tuple[int, str]  # cost, audit


# One segment ------------------------------------------------------------------------------------------------


def target_of(kind: str, length: int) -> str:
    if kind == "S":
        return ("s" + "ua" * (length // 2 + 1))[:length]
    return ("ua" if kind == "U" else "au") * (length // 2) + kind.lower() * (length % 2)


def shift(places: int) -> int:
    """Least cost of making a sequence longer (or, if negative, shorter) by some places."""
    return INSERT * places if places >= 0 else -DELETE * places


def aligned(turns: list[Turn], target: str, within: int) -> Best | None:
    """Least cost and ASCII-least audit of turning the turns into the target, if that costs no more than `within`."""
    n, m = len(turns), len(target)
    live = [0]
    for _, doomed, _ in turns:
        live.append(live[-1] + (not doomed))
    gap = m - live[n]
    least = DELETE * (n - live[n]) + shift(gap)
    if least > within:
        return None
    # Each place off the way costs an insertion and a deletion more.
    slack = (within - least) // (INSERT + DELETE)
    low, high = min(0, gap) - slack, max(0, gap) + slack
    rest: list[list[int]] = [[]] * (n + 1)  # cost from here to the end, by turn and place in the band
    first = [max(0, x + low) for x in live]
    last = [min(m, x + high) for x in live]
    for i in range(n, -1, -1):
        a, z = first[i], last[i]
        row = [INFINITE] * (z - a + 2)
        if i == n:
            for j in range(z, a - 1, -1):
                if not (j < m and target[j] == "s"):
                    row[j - a] = INSERT * (m - j)
            rest[i] = row
            continue
        initial, doomed, cut = turns[i]
        below, b, y = rest[i + 1], first[i + 1], last[i + 1]
        for j in range(z, a - 1, -1):
            best = DELETE + below[j - b] if b <= j <= y else INFINITE
            if j < m:
                if target[j] != "s" and j < z:
                    best = min(best, INSERT + row[j + 1 - a])
                if not doomed and b <= j + 1 <= y:
                    if target[j] == initial:
                        best = min(best, cut + below[j + 1 - b])
                    elif target[j] != "s":
                        best = min(best, REROLE + cut + below[j + 1 - b])
            row[j - a] = best
        rest[i] = row
    cost = rest[0][0 - first[0]]
    if cost > within:
        return None
    audit, i, j, left = [], 0, 0, cost
    get = lambda i, j: rest[i][j - first[i]] if first[i] <= j <= last[i] else INFINITE
    while i < n or j < m:  # letters in ASCII order: the first that keeps the cost is part of the least audit
        initial, doomed, cut = turns[i] if i < n else ("", True, False)
        if i < n and left == DELETE + get(i + 1, j):
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and left == INSERT + get(i, j + 1):
            audit.append("I")
            j += 1
        else:
            audit.append("K" if initial == target[j] else "R")
            i, j = i + 1, j + 1
        left = get(i, j)
    return cost, "".join(audit)


def plain_cost(turns: list[Turn], target: str) -> int:
    """Cost of taking turns and places in order: the first incumbent."""
    cost, j = 0, 0
    for initial, doomed, cut in turns:
        if doomed or j == len(target) or (target[j] == "s" and initial != "s"):
            cost += DELETE
        else:
            cost += cut + (0 if initial == target[j] else REROLE)
            j += 1
    return INFINITE if j < len(target) and target[j] == "s" else cost + INSERT * (len(target) - j)


def best_route(turns: list[Turn], routes: list[tuple[str, int, int]]) -> Best | None:
    """The best alignment to any target of some routes; lengths by their least possible cost, until that is too much."""
    live = sum(not doomed for _, doomed, _ in turns)
    bound = DELETE * (len(turns) - live)
    opener = any(initial == "s" and not doomed for initial, doomed, _ in turns)
    heads = []
    for kind, least, step in routes:
        if kind == "S" and not opener:
            continue
        lengths = {least}
        if step:
            near = max(least, live + (live - least) % 2)
            lengths |= {near, max(least, near - 2)}
        heads += [(bound + shift(m - live), m, kind, least, step) for m in lengths]
    if not heads:
        return None
    incumbent = min(plain_cost(turns, target_of(kind, m)) for _, m, kind, _, _ in heads)
    if incumbent == INFINITE:  # an opener that only other lengths reach
        incumbent = DELETE * len(turns) + INSERT * (3 + len(turns)) + len(turns)
    tries = []
    for kind, least, step in {(k, x, s) for _, _, k, x, s in heads}:
        top = live + max(0, incumbent - bound) // INSERT
        tries += [(bound + shift(m - live), m, kind) for m in (range(least, max(top, least) + 1, step) if step else [least])]
    best = None
    for least_cost, m, kind in sorted(tries):
        if least_cost > incumbent:
            break
        found = aligned(turns, target_of(kind, m), incumbent)
        if found and (best is None or found < best):
            best, incumbent = found, found[0]
    return best


def chained(a: dict, b: dict) -> dict:
    """Best alignments of two neighbouring stretches as one, by the state between them.

    Two audits of equal cost over the same turns are never one the start of the other, so the lesser stays the lesser.
    """
    out: dict[tuple[str, str], Best] = {}
    for (start, mid), (cost, audit) in a.items():
        for (again, end), (more, tail) in b.items():
            if mid == again:
                found = (cost + more, audit + tail)
                if (start, end) not in out or found < out[start, end]:
                    out[start, end] = found
    return out


def alignments(turns: list[Turn], whole: bool) -> dict[tuple[str, str], Best]:
    """Best alignment of a stretch for each pair of states; of a whole conversation only what can start and end it."""
    short = len(turns) <= SEGMENT
    wanted = [("0", "0"), ("0", "a")] if whole and short else list(ROUTES)
    out: dict[tuple[str, str], Best] = {}
    for start in range(0, max(1, len(turns)), SEGMENT):
        part = turns[start : start + SEGMENT]
        found = {key: best for key in wanted if (best := best_route(part, ROUTES[key]))}
        out = found if start == 0 else chained(out, found)
    return out


def chosen(tables: list[dict]) -> Best:
    """The cheapest repair of a conversation from the tables of its pieces in order."""
    total = tables[0]
    for more in tables[1:]:
        total = chained(total, more)
    return min(best for key, best in total.items() if key in (("0", "0"), ("0", "a")))


# The job ----------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as the fixed damage leaves them; a null role or text is one blank, a null id or turn counts as one."""
    as_text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn"))) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select("conv_id", "turn", kind.alias("_kind"), role.alias("role"), text.alias("text")).filter("_kind != 0").select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def ordered(rows: DataFrame) -> DataFrame:
    """All rows in one order, written once: `at` numbers them in it, `piece` is the part of the sort they fell into.

    By conversation, turn (nulls first), role and a hash of the text; the sort splits a long conversation like any other.
    """
    blank = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    said = (F.col("conv_id").isNull(), "conv_id", "role", "text")
    keyed = rows.withColumn("same", F.xxhash64(*said)).withColumn("same2", F.xxhash64(F.lit(7), *said))
    order = ["conv_id", "turn", "role", "same"]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return cut_lineage(placed.withColumn("piece", F.shiftright("at", 33).cast("int")))


def faults(placed: DataFrame) -> DataFrame:
    """(conv_id, turn, piece, at, initial, fault) of every row: its first fault of blank, duplicate, truncated."""
    bare = F.rtrim(F.col("text"), F.lit(GAPS))
    rows = placed.select(
        "conv_id", "turn", "piece", "at", "same", "same2", F.substring("role", 1, 1).alias("initial"),
        (F.ltrim(bare, F.lit(GAPS)) == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    # A row for each text, so a text that is said very often splits like any skewed join.
    first = rows.groupBy("same", "same2").agg(F.min("at").alias("first"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("at") > F.col("first"), DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(NONE)
    return rows.join(first, ["same", "same2"]).select("conv_id", "turn", "piece", "at", "initial", fault.cast("int").alias("fault"))


PIECE = (
    "conv_id {kind}, piece int, low long, high long, turns long, head string, tail string, blank long, duplicate long, truncated long, "
    "illegal long, ways array<struct<start: string, end: string, cost: long, audit: string>>"
)


def _pieces(found: DataFrame, kind: str) -> DataFrame:
    """What each piece of a conversation comes to, with its best alignments between any two states.

    Only the conversations at the ends of a sorted part can go on in another, the others are whole.
    """
    order = F.array_sort(F.collect_list(F.struct("at", "turn", "initial", "fault")))
    gathered = found.groupBy("conv_id", "piece").agg(order.alias("rows"))
    ends = found.groupBy("piece").agg(F.min("at").alias("from"), F.max("at").alias("to"))
    # One row for each part of the sort.
    gathered = gathered.join(F.broadcast(ends), "piece").select(
        "conv_id", "piece", F.col("rows.turn").alias("turn"), F.col("rows.initial").alias("initial"), F.col("rows.fault").alias("fault"),
        ((F.element_at("rows", 1)["at"] > F.col("from")) & (F.element_at("rows", -1)["at"] < F.col("to"))).alias("whole"),
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                initials, fault = r["initial"], r["fault"]
                known = [t for t in r["turn"] if t is not None]
                rows = [(i, f in (BLANK, DUPLICATE), f == TRUNCATED) for i, f in zip(initials, fault, strict=True)]
                ways = alignments(rows, r["whole"])
                out.append({
                    "conv_id": r["conv_id"], "piece": r["piece"], "low": min(known, default=None), "high": max(known, default=None),
                    "turns": len(set(known)), "head": initials[0], "tail": initials[-1], "blank": fault.count(BLANK),
                    "duplicate": fault.count(DUPLICATE), "truncated": fault.count(TRUNCATED),
                    "illegal": sum(a + b not in LEGAL for a, b in pairwise(initials)),
                    "ways": [{"start": s, "end": e, "cost": c, "audit": a} for (s, e), (c, a) in ways.items()],
                })
            yield pa.RecordBatch.from_pylist(out, schema)

    layout = T.StructType.fromDDL(PIECE.format(kind=kind))
    schema = to_arrow_schema(layout)
    return gathered.mapInArrow(summed, layout)


AUDIT = "conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(parts: DataFrame, kind: str) -> DataFrame:
    """Of each conversation from its pieces."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                pieces = sorted(r["pieces"], key=lambda p: p["piece"])
                cost, audit = chosen([{(w["start"], w["end"]): (w["cost"], w["audit"]) for w in p["ways"]} for p in pieces])
                known = [p for p in pieces if p["low"] is not None]
                turns = sum(p["turns"] for p in known) - sum(a["high"] == b["low"] for a, b in pairwise(known))
                out.append({
                    "conv_id": r["conv_id"], "gaps": known[-1]["high"] - known[0]["low"] + 1 - turns if known else 0,
                    "illegal": sum(p["illegal"] for p in pieces) + sum(a["tail"] + b["head"] not in LEGAL for a, b in pairwise(pieces)),
                    "cost": cost, "audit": audit, **{c: sum(p[c] for p in pieces) for c in ("blank", "duplicate", "truncated")},
                })
            yield pa.RecordBatch.from_pylist(out, schema)

    layout = T.StructType.fromDDL(AUDIT.format(kind=kind))
    schema = to_arrow_schema(layout)
    return parts.mapInArrow(joined, layout)


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, rows): one row per conversation that has rows, and the rows in order as `ordered` numbers them.

    audits: conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit, the letters of the cheapest edits: Keep,
    Rerole to user or assistant, Delete, Insert an empty turn. Rows may come in any order; equal turns go by role and text
    hash. A null conversation id is a conversation, null turns come first. A conversation's record in the last step is 16
    bytes a turn; its texts are never gathered.
    """
    placed = ordered(conversations)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    pieces = _pieces(faults(placed), kind)
    parts = pieces.groupBy("conv_id").agg(F.collect_list(F.struct(*[c for c in pieces.columns if c != "conv_id"])).alias("pieces"))
    return cut_lineage(_audits(parts, kind)), placed


class Editor:
    """Applies an audit to the turns of a conversation as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.opened = (len(audit) - audit.count("D")) % 2  # 1 if the repaired conversation starts with a system turn

    def _name(self) -> str:
        name = NAMES["ua"[(self.place - self.opened) % 2]]
        self.place += 1
        return name

    def inserted(self) -> Iterator[tuple[str, str]]:
        """The empty turns that stand here."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._name(), ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        step, self.at = self.audit[self.at], self.at + 1
        if step == "K":
            self.place += 1
            yield role, text
        elif step == "R":
            yield self._name(), text


def repaired_turns(audits: DataFrame, placed: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of the repaired conversations, streamed: each task holds one audit and a batch."""
    return _streamed(audits, placed, "conv_id {kind}, place long, role string, text string", _turns)


def repaired_digests(audits: DataFrame, placed: DataFrame) -> DataFrame:
    """(conv_id, sha) of the repaired `role:text` lines of each conversation."""
    return _streamed(audits, placed, "conv_id {kind}, sha string", _digests)


def _turns(conv, turns: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    for place, (role, text) in enumerate(turns):
        yield conv, place, role, text


def _digests(conv, turns: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    digest, gap = hashlib.sha256(), b""
    for role, text in turns:
        digest.update(gap + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        gap = b"\n"
    yield conv, digest.hexdigest()


def _streamed(audits: DataFrame, placed: DataFrame, layout: str, rows_of) -> DataFrame:
    """`rows_of` each conversation's repaired turns; its audit comes first, then its rows in order."""
    kind = audits.schema["conv_id"].dataType.simpleString()
    both = audits.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text")).union(
        placed.select("conv_id", "at", "role", "text")
    ).repartition("conv_id").sortWithinPartitions("conv_id", "at")

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for batch in batches for r in zip(*(batch[c].to_pylist() for c in ("conv_id", "at", "role", "text")), strict=True))
        held = next(rows, None)

        def turns(audit: str) -> Iterator[tuple[str, str]]:
            nonlocal held
            editor = Editor(audit)
            while (held := next(rows, None)) and held[1] >= 0:
                yield from editor.turn(held[2], held[3])
            yield from editor.inserted()

        def every() -> Iterator[tuple]:
            while held:
                yield from rows_of(held[0], turns(held[3]))

        out = []
        for row in every():
            out.append(row)
            if len(out) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=schema)

    shape = T.StructType.fromDDL(layout.format(kind=kind))
    schema = to_arrow_schema(shape)
    types = [f.type for f in schema]
    return both.mapInArrow(apply, shape)


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def op12_repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation after the fixed damage.

    A conversation that lost all rows has zeros, an empty audit and the digest of an empty text. Nulls, ties, blank and
    long texts and empty tables as in `damaged` and `repair`; repeated rows are turns of their own.
    """
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    audits, placed = repair(damaged(rows))
    result = audits.join(
        repaired_digests(audits, placed).withColumnRenamed("conv_id", "_conv"), F.col("conv_id").eqNullSafe(F.col("_conv"))
    ).drop("_conv")
    every = rows.select("conv_id").distinct().withColumnRenamed("conv_id", "_all")
    return every.join(result, F.col("_all").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_all").alias("conv_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in NUMBERS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
