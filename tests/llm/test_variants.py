from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslens.llm import variants


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_hand(counts: dict[str, int]) -> dict[str, tuple]:
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = {}
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, counts[w], len(near[w]), counts.get(form.get(w)))
    return out


def vocabulary_by_hand(docs: list) -> dict[str, int]:
    found: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def result(df) -> dict[str, tuple]:
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


@settings(max_examples=500, deadline=None)
@given(st.text("abé", max_size=7), st.text("abé", max_size=7))
def test_prefix_and_suffix_tell_single_edits(a, b):
    m = max(len(a), len(b))
    if m < 2 or not a or not b or a == b or abs(len(a) - len(b)) > 1:  # no group holds such words
        return
    both = [len(x[0]) for tail in (False, True) for x in [variants.single_edits([a], [b], m, tail)]]
    prefix, suffix = a[: m // 2] == b[: m // 2], a[::-1][: m - m // 2] == b[::-1][: m - m // 2]
    # Of the groups that two words share, exactly one reports them, and only if they are one edit apart.
    reported = both[0] * prefix + both[1] * suffix
    assert reported == one_edit(a, b)


@pytest.mark.parametrize("tile", [1, 3, 1024])
def test_against_brute_force(spark, tile):
    rng = random.Random(tile)
    words = set()
    while len(words) < 700:
        word = "".join(rng.choice("abcé") for _ in range(rng.randint(5, 8)))
        words |= {word, *(w for w in (word[:-1] + "z", word[1:], word[:2] + "\U0001f600" + word[2:]) if len(w) >= 5 and rng.random() < 0.3)}
    counts = {w: int(3 * 1.6 ** rng.randint(0, 14)) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    assert result(variants.spelling_variants(df, tile)) == by_hand(counts)


def test_ties_go_to_the_smallest_word(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaaaé": 6, "aaaaz": 6, "zaaaab": 12, "zzaaaab": 24, "alone": 5}
    got = result(variants.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == by_hand(counts) and got["aaaaa"][0] == "aaaab" and got["aaaaa"][1] == "zzaaaab"


def test_a_word_goes_to_each_pair_of_tiles_once(spark):
    words = [("stem" + "abcdefgh"[i % 8] + "abcdefgh"[i // 8 % 8] + "abcdefgh"[i // 64], 3) for i in range(500)]
    rows = variants.tiled(spark.createDataFrame(words, "word string, n long"), 100)
    work = rows.groupBy("m", "tail", "part", "a", "b").count()
    assert work.agg({"count": "max"}).first()[0] <= 2 * 100 * 1.6
    prefix = rows.filter("m = 7 and not tail")
    tiles = 1 + prefix.agg({"b": "max"}).first()[0]
    assert tiles == 5 and prefix.count() == 500 * tiles


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(variants.op13_spelling_variants(spark, sf)) == by_hand(vocabulary_by_hand(docs))


def test_odd_rows(spark, odd, none):
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    more = [(None, "Caféteria caféteria CAFÉteria cafÉteria"), (9, "naïveté " * 3 + "naivete " * 7), (None, "x" * 70000), (9, "a×b÷c " * 3)]
    df = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).selectExpr("*", "'x' as n", "'y' as word")
    want = by_hand(vocabulary_by_hand(docs + more))
    assert result(variants.spelling_variants(variants.vocabulary(df))) == want and "a×b÷c" in want
    assert result(variants.spelling_variants(variants.vocabulary(none))) == {}
