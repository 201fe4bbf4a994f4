from __future__ import annotations

import random

import corpus_pipeline
from corpuslens.llm import minhash, simhash


def windows(text: str) -> set[str]:
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def edited(rng: random.Random, words: list[str], edits: int) -> str:
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.getrandbits(30)}"
    return " ".join(words)


def test_stage_finds_pairs_of_similarity_0_8_as_brute_force_does(spark):
    rng = random.Random(3)
    texts = []
    for _ in range(40):
        words = [f"w{rng.getrandbits(30)}" for _ in range(300)]
        texts += [" ".join(words), *(edited(rng, words, e) for e in (2, 4, 6, 7, 9))]
    sets = [windows(t) for t in texts]
    root = list(range(len(texts)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    similar = []
    for i in range(len(texts)):
        for j in range(i):
            share = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if share >= 0.8:
                similar.append(share)
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert len([s for s in similar if s < 0.95]) > 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.keep_one(df).collect())
    assert kept == [i for i in range(len(texts)) if find(i) == i]


def test_chains_join_through_members_that_are_not_first(spark):
    """Each text is similar to the next only, so links to one leader don't span the group."""
    words = [f"w{i}" for i in range(700)]
    texts = [" ".join(words[s : s + 400]) for s in range(0, 300, 20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in simhash.keep_one(df).collect()] == [0]


def bits_apart(a: str, b: str) -> int:
    return ((simhash.fingerprint_of(a.encode()) ^ simhash.fingerprint_of(b.encode())) & ((1 << 64) - 1)).bit_count()


def test_the_stage_joins_what_either_measure_links(spark):
    """b is like a by its shingles only, c like b by its fingerprint only, d like nobody."""
    rng = random.Random(5)
    while True:
        words = [f"w{rng.getrandbits(30)}" for _ in range(300)]
        a, b = " ".join(words), edited(rng, words, 5)
        c = next((x for x in (edited(rng, b.split(), 9) for _ in range(60)) if bits_apart(b, x) <= 4 < bits_apart(a, x)), None)
        if c and bits_apart(a, b) > 4:
            break
    sets = [minhash.shingles_of(x) for x in (a, b, c)]
    assert minhash.similarity(sets[0], sets[1]) >= 0.8 > max(minhash.similarity(sets[k], sets[2]) for k in (0, 1))
    d = " ".join(f"v{rng.getrandbits(30)}" for _ in range(300))
    rows = [(3, c), (2, b), (1, a), (4, d), (5, None), (None, ""), (None, d)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_copies(spark, df, "").collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == [(1, a), (4, d)] and [r.doc_id for r in kept if not r.text] == [5]


def test_exact_similarity():
    a, b = "a b c d e f g h i j", "A b c d e f g h i k"
    want = len(windows(a) & windows(b)) / len(windows(a) | windows(b))
    assert minhash.similarity(minhash.shingles_of(a), minhash.shingles_of(b)) == want


def test_a_group_of_alike_texts_makes_few_pairs(spark, monkeypatch):
    """Copies with few to many edits: those close to the original link to it, the far ones meet nobody."""
    rng = random.Random(9)
    words = [f"w{rng.getrandbits(30)}" for _ in range(200)]
    texts = [edited(rng, words, rng.randint(0, 8)) for _ in range(500)]
    sets = [windows(t) for t in texts]
    root = list(range(len(texts)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    seen = []
    compare = minhash._linked
    monkeypatch.setattr(minhash, "_linked", lambda pairs, *rest: seen.append(pairs.count()) or compare(pairs, *rest))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.keep_one(df).collect())
    assert kept == [i for i in range(len(texts)) if find(i) == i] and len(kept) > 50
    assert sum(seen) < 30 * len(texts)  # all pairs were 125,000


def test_odd_rows(odd, none):
    rows = minhash.near_copies(odd).collect()
    assert len(rows) == 10 and minhash.near_copies(none).count() == 0
    root = {}
    for r in rows:
        root.setdefault(r.root, []).append(r.doc_id)
    assert sorted(sorted(-1 if i is None else i for i in g) for g in root.values()) == [[-1], [-1, 2, 3, 4], [1, 1, 6], [5], [7]]


def test_columns_of_any_name_stay(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", "k", "i", "n", 4), (2, "a b c d e f g", "l", "j", "m", 5)],
                               "doc_id long, text string, _key string, _id string, key string, n int")
    assert [tuple(r) for r in simhash.keep_one(df).collect()] == [(1, "a b c d e f g", "k", "i", "n", 4)]
