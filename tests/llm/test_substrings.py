from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpuslens.llm import substrings


def by_hand(docs: list[tuple[int, str | None]], window: int) -> dict[int, tuple[int, int, str]]:
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: d[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                gone[s : s + window] = [True] * window
            seen.add(w)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[i] = (len(words), sum(gone), kept.decode())
    return out


def corpus(rng: random.Random, n: int) -> list[tuple[int, str]]:
    shared = [" ".join(f"s{rng.randrange(9)}" for _ in range(rng.randint(3, 40))) for _ in range(4)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts.append(rng.choice(shared) if rng.random() < 0.4 else " ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))))
        docs.append((i * 3 - n, "\n".join(parts)))
    return docs


@pytest.mark.parametrize(("window", "leaves"), [(20, 1 << 21), (5, 7), (1, 40), (3, 1 << 21), (16, 11)])
def test_against_brute_force(spark, window, leaves):
    """Small groups force many splits, so prefixes of every depth are in use."""
    docs = corpus(random.Random(window), 120)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(df, window, leaves).collect()}
    assert got == by_hand(docs, window)
    assert sum(x[1] for x in got.values()) > 0


def test_prefixes_vary_in_length(spark):
    """Words that are common are split by the next, a passage that is common down to its whole length."""
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"{passage} {t}") for i, t in corpus(random.Random(5), 120)]
    df = spark.createDataFrame(docs, "place long, text string").selectExpr("place", "xxhash64(text) as key", "cast(text as binary) as text")
    heavy, groups = substrings.split_prefixes(df, 20, 50)
    assert groups > 8 and sorted(heavy) == [1, 2, 4, 8, 16]
    assert all(len(p) <= groups for p in heavy.values())
    assert len(heavy[16]) < len(heavy[2])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=0, max_size=60), st.integers(1, 24))
def test_paths_are_equal_just_where_words_are(words, window):
    hashes = np.array([hash(("w", w)) % (1 << 61) for w in words], np.uint64)
    depths = []
    for depth, path in substrings.paths(hashes, window):
        depths.append(depth)
        spans = [tuple(words[i : i + depth]) for i in range(len(words) - depth + 1)]
        assert len(path) == max(0, len(spans))
        assert len(set(path.tolist())) == len(set(spans))
    assert depths == substrings.steps(window)


def test_long_texts_are_cut_at_white_space():
    data = ("é a\tbb c\n" * 5000).encode() + b"x" * 9000
    for size in (1, 7, 1000, 1 << 20):
        assert [w for part in substrings.pieces(data, size) for w in part] == data.split()


def test_one_passage_in_every_document(spark):
    """A passage that fills half of all suffixes is repeated everywhere but in its first place."""
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"u{i} {passage} v{i}") for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = {r.doc_id: r for r in substrings.remove_repeats(df, 20, 50).collect()}
    assert rows[0].n_removed == 0 and rows[0].kept == docs[0][1]
    assert all(r.kept == f"u{i} v{i}" and [tuple(s) for s in r.spans] == [(1, 30)] for i, r in rows.items() if i)


def test_odd_rows(odd, none):
    rows = substrings.remove_repeats(odd).collect()
    assert len(rows) == 10 and substrings.remove_repeats(none).count() == 0
    first = [r for r in rows if r.doc_id == 1]
    assert len(first) == 2 and all(r.n_removed == 0 and r.kept for r in first)  # a repeated row is the same document
    assert all((r.n_words, r.n_removed, r.kept) == (0, 0, "") for r in rows if r.doc_id in (2, 3, 4))
    long = next(r for r in rows if r.doc_id == 5)
    assert long.n_words == 32000 and long.n_removed == 32000 - 8 and [s.start for s in long.spans] == [8]


def test_query_digests(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {d: (n, g, hashlib.sha256(k.encode()).hexdigest()) for d, (n, g, k) in by_hand(docs, 20).items()}
    got = {r.doc_id: tuple(r)[1:] for r in substrings.op11_repeated_passages(spark, sf).collect()}
    assert got == want
