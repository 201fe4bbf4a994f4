from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import pairwise

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslens.llm import dialogue

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
STATES = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def by_states(turns: list) -> tuple[int, str]:
    """The cheapest repair by states of the grammar, without targets, lengths or bands."""

    def inserts(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                for x in "ua":
                    to = STATES.get((state, x))
                    if to and (to not in best or (cost + 2, audit + "I") < best[to]):
                        best[to] = (cost + 2, audit + "I")
        return best

    best = inserts({"0": (0, "")})
    for initial, doomed, cut in turns:
        out = {}

        def offer(state, value, out=out):
            if state and (state not in out or value < out[state]):
                out[state] = value

        for state, (cost, audit) in best.items():
            offer(state, (cost + 3, audit + "D"))
            if not doomed:
                offer(STATES.get((state, initial)), (cost + cut, audit + "K"))
                for x in "ua":
                    offer(STATES.get((state, x)), (cost + 2 + cut, audit + "R"))
        best = inserts(out)
    return min(best[s] for s in ("0", "a") if s in best)


def every_audit(turns: list, most: int) -> tuple[int, str]:
    """The cheapest repair among all edit sequences with few insertions."""
    found = []

    def go(i, made, cost, audit, inserted):
        if i == len(turns) and GRAMMAR.match(made):
            found.append((cost, audit))
        if inserted < most:
            for x in "ua":
                go(i, made + x, cost + 2, audit + "I", inserted + 1)
        if i < len(turns):
            initial, doomed, cut = turns[i]
            go(i + 1, made, cost + 3, audit + "D", inserted)
            if not doomed:
                go(i + 1, made + initial, cost + cut, audit + "K", inserted)
                for x in "ua":
                    go(i + 1, made + x, cost + 2 + cut, audit + "R", inserted)

    go(0, "", 0, "", 0)
    return min(found)


turn = st.tuples(st.sampled_from("suat"), st.booleans(), st.booleans())


@settings(max_examples=150, deadline=None)
@given(st.lists(turn, max_size=4))
def test_against_all_edit_sequences(turns):
    assert by_states(turns) == every_audit(turns, 3)


@settings(max_examples=400, deadline=None)
@given(st.lists(turn, max_size=14), st.booleans())
def test_alignment_is_the_cheapest_with_the_least_audit(turns, whole):
    assert dialogue.chosen([dialogue.alignments(turns, whole)]) == by_states(turns)


@settings(max_examples=150, deadline=None)
@given(st.lists(turn, max_size=24), st.lists(st.integers(0, 24), max_size=3), st.sampled_from([2, 3, 5]))
def test_pieces_and_segments_join_to_the_same_repair(turns, cuts, size):
    edges = [0, *sorted(min(c, len(turns)) for c in cuts), len(turns)]
    old, dialogue.SEGMENT = dialogue.SEGMENT, size
    try:
        tables = [dialogue.alignments(turns[a:z], False) for a, z in pairwise(edges) if z > a or not turns]
        assert dialogue.chosen(tables) == by_states(turns)
    finally:
        dialogue.SEGMENT = old


@pytest.mark.parametrize("n", [64, 65, 700])
def test_long_conversations(n):
    rng = random.Random(n)
    turns = [("s" if not i else "ua"[(i + 1) % 2], rng.random() < 0.08, rng.random() < 0.08) for i in range(n)]
    turns = [t for t in turns if rng.random() > 0.05]
    assert dialogue.chosen([dialogue.alignments(turns, True)]) == by_states(turns)


def by_hand(rows: list) -> dict:
    """The contract, row by row."""
    conversations: dict = {}
    for conv, turn_, role, text in rows:
        out = conversations.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn_ is None else turn_}".encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(turn_, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    result = {}
    for conv, turns in conversations.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        seen, kinds = set(), []
        for _, role, text in turns:
            bare = text.strip(" \t\n\x0b\x0c\r")
            kinds.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = by_states([(t[1][:1], k in ("b", "d"), k == "t") for t, k in zip(turns, kinds, strict=True)])
        made, i = [], 0
        opened = sum(a != "D" for a in audit) % 2
        name = lambda made=made, opened=opened: ("user", "assistant")[(len(made) - opened) % 2]
        for a in audit:
            if a == "I":
                made.append(f"{name()}:")
                continue
            if a == "K":
                made.append(f"{turns[i][1]}:{turns[i][2]}")
            elif a == "R":
                made.append(f"{name()}:{turns[i][2]}")
            i += 1
        known = [t[0] for t in turns if t[0] is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(turns))
        result[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, kinds.count("b"), kinds.count("d"),
                        kinds.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return result


COLUMNS = (*dialogue.NUMBERS, "audit", "repaired_sha256")


def results(spark, rows, tmp_path) -> dict:
    path = f"{tmp_path}/t{random.getrandbits(40)}"
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("_kind", dialogue.F.lit("x"))
    df.repartition(3).write.parquet(f"{path}/conversations.parquet")
    out = dialogue.op12_repaired_conversations(spark, path).collect()
    assert len({r.conv_id for r in out}) == len(out)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in out}


def test_query_against_the_contract(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = dialogue.op12_repaired_conversations(spark, sf).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in out} == by_hand(rows)


def test_one_long_conversation_is_cut_and_joined(spark, tmp_path):
    """Half of all rows belong to one conversation: the sort cuts it into several pieces."""
    rng = random.Random(4)
    rows = [(7, i, rng.choice(["user", "assistant", "assistant", "user", "system"]), f"text {rng.randrange(900)}.") for i in range(1500)]
    rows += [(100 + i // 4, i % 4, ("user", "assistant")[i % 2], f"hello {i}.") for i in range(1200)]
    rng.shuffle(rows)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # as if the table were large
    try:
        placed = dialogue.ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
        assert placed.filter("conv_id = 7").select("piece").distinct().count() > 1
        assert results(spark, rows, tmp_path) == by_hand(rows)
    finally:
        spark.conf.set(key, "true")


def test_odd_rows(spark, tmp_path):
    rows = [
        (None, None, None, None), (None, 1, "user", "a."), (1, None, "user", "x."), (1, None, "assistant", "y"), (1, 5, "user", "é…"), (2, 1, None, "z."),
        (3, 1, "", "empty role."), (4, 1, "system", "s."), (4, 2, "tool", "t."), (5, 3, "user", "long! " * 30000), (5, 4, "assistant", "\n\t "),
        (6, 1, "user", "same."), (6, 1, "user", "same."), (6, 1, "assistant", "tie."),
    ]
    assert results(spark, rows, tmp_path) == by_hand(rows)
    assert results(spark, [], tmp_path) == {}


def test_repaired_conversations_follow_the_grammar(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    audits, placed = dialogue.repair(dialogue.damaged(rows))
    made: dict = {}
    for r in sorted(dialogue.repaired_turns(audits, placed).collect(), key=lambda r: (r.conv_id, r.place)):
        made[r.conv_id] = made.get(r.conv_id, "") + r.role[0]
    assert made and all(GRAMMAR.match(m) for m in made.values())
