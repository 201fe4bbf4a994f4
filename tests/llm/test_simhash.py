from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpuslens.llm import components, simhash


def by_hand(text: str | None) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(codes: list[int], distance: int) -> dict[int, int]:
    left, root = set(codes), {}
    while left:
        todo = [min(left)]
        group = set()
        while todo:
            c = todo.pop()
            if c in group:
                continue
            group.add(c)
            todo += [x for x in left if (x ^ c).bit_count() <= distance]
        left -= group
        root |= {c: min(group) for c in group}
    return root


def clusters(seed: int, n: int, spread: int, far: int = 40) -> list[int]:
    """Codes around one centre, or around several where so few flips don't give enough codes."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(far)}
    centres = [rng.getrandbits(64) for _ in range(1 + n // 40 if spread < 2 else 1)]
    while len(out) < n:
        centre = rng.choice(centres)
        out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, spread))))
    return sorted(out)


def test_fingerprints_equal_the_definition():
    for text in ("", None, "one", "A b C", "a b c d", "Ünï x\ty\nz \u00a0 w " * 30, "x " * 200000 + "y"):
        assert simhash.fingerprint_of((text or "").encode()) % (1 << 64) == by_hand(text)


def test_a_text_longer_than_a_block():
    text = " ".join(str(i % 97) for i in range(5000)).encode()
    assert simhash.fingerprint_of(text, block=64) == simhash.fingerprint_of(text)


def test_spark_hash_is_the_same(spark):
    row = spark.createDataFrame([("a b c d",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % (1 << 64) == xxhash.xxh64_intdigest("a b c d", 42)


@pytest.mark.parametrize("spread", [1, 3, 6])
def test_index_finds_all_pairs(spread):
    codes = np.array(clusters(spread, 400, spread), np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    got = {(int(i), int(j)) for a, b in simhash.close_pairs(codes, 4) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if int(codes[i] ^ codes[j]).bit_count() <= 4}
    assert got == want


@pytest.mark.parametrize("distance", [3, 4])
@pytest.mark.parametrize("leaf", [4096, 20, 2])
def test_links_span_the_same_groups_on_every_route(spark, distance, leaf):
    codes = clusters(7, 160, 5)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    found = simhash.links(df, distance, leaf).collect()
    assert len(found) < 10 * (64 + len(codes)) * len(codes)
    assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 64 for r in found)
    rooted = {r.node: r.root for r in components.connected(spark.createDataFrame(found, "a long, b long")).collect()}
    want = groups(codes, distance)
    got = {}
    for c, s in zip(codes, signed, strict=True):
        got.setdefault(rooted.get(s, s), set()).add(c)
    assert sorted(map(sorted, got.values())) == sorted(
        sorted(c for c in codes if want[c] == r) for r in set(want.values())
    )


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 600)] + [(7, 7), (900, 900), (None, 3)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{i: 500 for i in range(500, 600)}}


def test_odd_rows(odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 10 and simhash.near_duplicates(none).count() == 0
    blank = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert {(r.fp, r.component_id) for r in blank} == {(0, 2)}
    assert {r.component_id for r in rows if r.doc_id in (1, 6)} == {1}
    assert [r.component_id for r in rows if r.doc_id is None and r.fp == 0] == [2]
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 2, 5, 7]
    assert simhash.keep_one(none).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op1_simhash_components(spark, sf).collect()}
    code = {d: by_hand(t) for d, t in texts.items()}
    root = groups(sorted(set(code.values())), 4)
    least = {}
    for d, c in code.items():
        least[root[c]] = min(least.get(root[c], d), d)
    assert got == {d: (f"{c:016x}", least[root[c]]) for d, c in code.items()}
