"""Byte-level BPE, HTML text, packed ids, neighbours and the language model."""

from __future__ import annotations

import math
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from corpuslens import session
from corpuslens.llm import binary_output, byte_bpe, html_text, maxent, nearest, quality

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(1 << 16, 1 << 10), (50, 10), (7, 3), (16, 15)])
def test_bpe_equals_the_library(spark, odd, none, chunk, overlap):
    more = [(20, "a" * 300, "x"), (21, "it's  12345 \n\n   spaced   out" * 9, None), (22, " " * 200 + "x", "y"), (23, "!" * 99 + "漢" * 99, "z")]
    rows = odd.select("doc_id", "text", "tokens").union(spark.createDataFrame(more, "doc_id long, text string, tokens string"))
    if chunk < 1000:
        rows = rows.filter("length(text) < 10000 or text is null")
    encoded = byte_bpe.encode(rows, RANKS, public_tokenizers.PATTERN, chunk, overlap)
    got = encoded.withColumn("bytes", byte_bpe.decoder(spark, RANKS)("tokens")).collect()
    assert len(got) == rows.count()
    for r in got:
        assert r.tokens == LIBRARY.encode_ordinary(r.text or "") and bytes(r.bytes) == (r.text or "").encode()
    assert byte_bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0


def test_stitching_without_shared_boundaries():
    pattern, chunk, overlap = regex.compile(r"x+|."), 8, 2
    for text in ("x" * 40, "ab" + "x" * 21 + "cdefgh" * 5, "x" * 7 + "y" + "x" * 30 + "z"):
        at = list(range(0, max(1, len(text) - overlap), chunk))
        parts = [text[a : a + chunk + overlap] for a in at]
        group = pd.DataFrame({"start": at, "text": parts, "starts": [[a + m.start() for m in pattern.finditer(p)] for a, p in zip(at, parts, strict=True)]})
        found = []
        for x in byte_bpe.stitch(group, pattern, chunk):
            found += [x] if isinstance(x, str) else pattern.findall(group["text"][x[0]])[x[1] : x[2]]
        assert found == pattern.findall(text)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="ad big">Buy</div><!-- c -->
<article class="post-12 post"><h1>The &amp; title</h1><p>One  <b>bo</b>ld<br>line,
with words.<p>Two &lt;x&gt; &quot;q&quot;</p><form><input value="f">Send</form><aside>Side</aside><div id="comments"><p>Reader</p></div>
<ul><li>Item<li>Next</ul></article><footer>&copy; F</footer>"""


def test_main_text():
    page = html_text.read_page(PAGE)
    want = 'The & title One bold line, with words. Two <x> "q" Item Next'
    assert html_text.main_text(page, None) == want
    first = next(e for e, t, _ in page.blocks if t.startswith("The"))
    assert html_text.path_of(page, first).startswith("html/body/article.post.post-/")
    assert html_text.main_text(page, "html/body/article.post.post-") == html_text.main_text(page, "no/such") == want
    assert html_text.main_text(html_text.read_page("plain text, no tags"), None) == "plain text, no tags"


def test_hosts_vote(spark):
    page = "<html><body><div class='m{}'><p>Main {} text with several words, and commas, here.</p></div><div class='x'><p>{}</p></div></body></html>"
    rows = [(i, "http://h.org/" + str(i), page.format(i, i, "short")) for i in range(9)]
    rows += [(9, "http://h.org/9", page.format(9, 9, "An odd long block that would win by itself. " * 9)), (10, None, None), (11, "http://k.org/", ""), (9, None, "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("old"))
    got = html_text.extract(df).collect()
    assert len(got) == 13
    texts = {(r.page_id, r.url is None): r.text for r in got}
    assert texts[(9, False)] == "Main 9 text with several words, and commas, here."
    assert texts[(10, True)] == "" and texts[(11, False)] == "" and texts[(9, True)] == "x"
    assert html_text.extract(df.filter("false")).count() == 0


def test_best_fit_takes_the_tightest_bin():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 500).tolist()
    got, free, want = binary_output.best_fit(lengths, 100), [], []
    for i in sorted(range(500), key=lambda k: (-lengths[k], k)):
        fits = [f for f in free if f >= lengths[i]]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - lengths[i])
        else:
            free.append(100 - lengths[i])
        want.append(i)
    assert len(got) == len(free) and sorted(i for b in got for i in b) == sorted(want)
    assert sorted(100 - sum(lengths[i] for i in b) for b in got) == sorted(free)


@pytest.mark.parametrize("width", [8, 64, 4096])
def test_packed_ids_round_trip(spark, odd, none, tmp_path, width):
    rows = odd.filter("doc_id is null or doc_id <> 5") if width == 8 else odd
    written = binary_output.write_packed(binary_output.pack_documents(rows, width, 1000), str(tmp_path / "p")).collect()
    found: dict = {}
    for r in written:
        ids = np.frombuffer(r.input_ids, "<u2")
        assert len(ids) == width and r.cu_seqlens[-1] == r.n_tokens and not ids[r.n_tokens :].any()
        assert r.position_resets == r.cu_seqlens[:-1]
        for doc, at, a, b in zip(r.doc_ids, r.doc_offsets, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            found.setdefault(doc, []).append((at, ids[a:b]))
    texts = {}
    for r in rows.collect():
        texts.setdefault(r.doc_id, []).append((r.text or "").encode())
    for doc, pieces in found.items():
        total = sum(len(p) for _, p in pieces)
        assert total == sum(len(t) + 1 for t in texts[doc])
        if len(texts[doc]) == 1:
            ids = np.concatenate([p for _, p in sorted(pieces, key=lambda x: x[0])])
            assert (ids[:-1] - 3).astype(np.uint8).tobytes() == texts[doc][0] and ids[-1] == binary_output.END
    assert binary_output.pack_documents(none, width).count() == 0


def test_neighbours(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    got: dict = {}
    for r in nearest.op8_nearest_vectors(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q, found in got.items():
        scores = x @ x[ids == q][0]
        want = [i for i in ids[np.lexsort((ids, -scores))] if i != q][:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and all(abs(s - scores[ids == v][0]) < 1e-12 for _, v, s in found)
        hits += len(set(want) & {v for _, v, _ in found})
    assert len(got) == 25 and hits / (20 * len(got)) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [2.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (10, [-1.0, 0.5]), (40, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    good = nearest.usable(df, "vec_id", "embedding")
    for slice_rows in (8192, 2):
        got = nearest.nearest(good, good.filter("id % 20 = 0"), k=3, slice_rows=slice_rows, query_rows=1, width=9.0).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [
            (0, 1, 2), (0, 2, 3), (0, 3, 20), (20, 1, 2), (20, 2, 0), (20, 3, 3),
        ]
    assert nearest.nearest(good.filter("false"), good.filter("false")).count() == 0


def test_maxent_base_and_sum(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    low = lambda t: (t or "").encode().lower().split() + [maxent.END]
    tokens = {d: low(t) for d, t in texts.items()}
    held = {d: crc32(str(d).encode()) % 10 == 0 for d in texts}
    c = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(c.values()), len(c)
    better = 0
    for r in maxent.op10_maxent_scores(spark, sf).collect():
        ws = tokens[r.doc_id]
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(w in c for w in ws), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isfinite(r.score)
        better += r.held_out * (r.score - base)
    assert better > 0


def test_maxent_sums_to_one(spark, odd, none, monkeypatch):
    texts = ["a b c a b. and so on", "b c a the the the end", "q r s"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = maxent.word_counts(docs)
    words = [bytes(r.word) for r in counts.collect()]
    for known in (maxent.KNOWN, 4):  # all words travel with the code, or only four
        monkeypatch.setattr(maxent, "KNOWN", known)
        model = maxent.train(docs, counts)
        (kept, _), by_class, by_member, size = model.value
        assert np.allclose(np.power(10.0, by_class).sum(axis=1), 1, atol=1e-4)
        total = 0.0
        for w in [x.decode() for x in words if x != maxent.END]:
            two = maxent.score(spark.createDataFrame([(1, f"a {w}"), (2, "a")], "doc_id long, text string"), model, counts)
            assert two.count() == 2
        assert maxent.score(odd, model, counts).count() == 10 and maxent.score(none, model, counts).count() == 0
        total = _mass(model, counts)
        assert abs(total - 1) < 1e-4
    empty = maxent.word_counts(none)
    rows = maxent.score(odd, maxent.train(none, empty), empty).collect()
    assert len(rows) == 10 and all(math.isfinite(r.score) and r.base_score == 0 for r in rows)


def _mass(model, counts) -> float:
    """Probability of all words and of one unknown per ending, after the start of a text."""
    words, by_class, by_member, size = model.value
    v = maxent.Vocabulary(*words)
    sums = np.zeros(maxent.TAIL)
    total = 0.0
    for r in counts.collect():
        s = v.slots[bytes(r.word)]
        if v.head[s]:
            total += 10.0 ** (by_class[0, v.class_[s]] + by_member[0, v.place[s]])
        else:
            sums[v.class_[s] - maxent.HEAD] += r.c + 0.1
    tail = (sums + 0.1) / 10.0**size
    empty_heads = [k for k in range(maxent.HEAD) if not np.isfinite(by_member[0, k * maxent.MEMBERS : (k + 1) * maxent.MEMBERS]).any()]
    return total + float((tail * 10.0 ** by_class[0, maxent.HEAD :]).sum()) + float((10.0 ** by_class[0, empty_heads]).sum())


def test_maxent_knows_whole_words_before(spark, monkeypatch):
    """Words that aren't known and end alike lead to different words; sums by brute force, all features of a place included."""
    texts = ["p1xyz q1xyz end", "p2xyz q2xyz one", "p1xyz q1xyz end two", "p2xyz q2xyz one end", None] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ask = ["p1xyz q1xyz end", "p2xyz q2xyz end", "p1xyz q1xyz one", "p1xyz q1xyz end", "new words here", None, ""]
    asked = spark.createDataFrame([(7, t) for t in ask], "doc_id long, text string")
    counts = maxent.word_counts(docs)
    for known in (maxent.KNOWN, 1):
        monkeypatch.setattr(maxent, "KNOWN", known)
        model = maxent.train(docs, counts)
        want = sorted(_by_hand(model.value, texts, t) for t in ask)
        for chunk in (maxent.CHUNK, 2):  # also chunks within a text
            monkeypatch.setattr(maxent, "CHUNK", chunk)
            got = sorted(r.score for r in maxent.score(asked, model, counts).collect())
            assert np.allclose(got, want, rtol=1e-5)
        monkeypatch.undo()
    good, bad = (_by_hand(model.value, texts, t) for t in ask[:2])
    assert good > bad + 0.3
    both = docs.unionAll(asked.withColumn("doc_id", F.col("doc_id") + 100))
    once = maxent.score(both, model, counts, F.col("doc_id") < 100).filter("doc_id > 100").collect()
    assert np.allclose(sorted(r.score for r in once), want, rtol=1e-5)


def test_maxent_encodes_texts_across_blocks(spark, monkeypatch):
    """Chunks and blocks that end within a text hand on the two words before."""
    texts = {0: "one two three four five six seven", 1: "two", 2: None, 3: "a b c rare " * 9, 4: "", 5: "x" * 30 + " a b"}
    whole, known = maxent.word_blocks, ([b"two", b"a", b"b", maxent.END], [4, 3, 2, 1])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    v = maxent.Vocabulary(*known)
    for block, chunk, most in ((1 << 22, 1 << 19, 1 << 14), (8, 5, 1 << 14), (3, 1, 2), (20, 1 << 19, 3)):
        monkeypatch.setattr(maxent, "word_blocks", lambda text, size=block: whole(text, size))
        monkeypatch.setattr(maxent, "CHUNK", chunk)
        monkeypatch.setattr(maxent, "SEGMENTS", most)
        encoded = maxent.encode(docs, spark.sparkContext.broadcast(known), F.col("doc_id") > 1).collect()
        monkeypatch.undo()
        row = {int(r.doc_id): r for r in encoded if r.chunk < 0}
        got = {r._row: [] for r in row.values()}
        chunks = sorted((r for r in encoded if r.chunk >= 0), key=lambda r: r.chunk)
        assert len({r.chunk for r in chunks}) == len(chunks)
        for r in chunks:
            p = maxent.Places(v, r)
            of = np.repeat(np.frombuffer(r.ids, np.int64), p.lengths).tolist()
            flags = np.repeat(p.flags, p.lengths).tolist()
            for i, *place in zip(of, flags, p.slots.tolist(), p.context.tolist(), *(x.tolist() for x in p.hashes), strict=True):
                got[i].append(tuple(place))
        for d, text in texts.items():
            (slots, context, words), = v.read(text)
            h = [0, 0, *maxent.digests(words).tolist()]
            flags = [maxent.WANTED + maxent.LEARNS * (d > 1)] * len(words)
            assert got[row[d]._row] == list(zip(flags, slots.tolist(), context.tolist(), h[2:], h[1:], h, strict=False))
            assert (row[d].n_tokens, row[d].known) == (len(words), sum(w in known[0] for w in words))
            rest = Counter(w for w in words if w not in known[0])
            assert dict(zip(map(bytes, row[d].words), row[d].times, strict=True)) == rest


def test_packed_numbers():
    rng = np.random.default_rng(3)
    for dtype in (np.uint8, np.uint16, np.uint64):
        for n in (1, 2, 1000):
            x = rng.integers(0, np.iinfo(dtype).max, n, dtype, endpoint=True)
            back = maxent.unpack(maxent.pack(x), dtype)
            assert back.dtype == dtype and back.tolist() == x.tolist()


def test_shuffle_files_go_with_the_job(spark):
    """Each job of the model frees the disk that its shuffles took before the next begins."""

    def files() -> set[str]:
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = manager.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_") and n.endswith(".data")}

    df = spark.range(50_000).groupBy((F.col("id") % 9973).alias("k")).agg(F.sum("id").alias("s"))
    before, set_to = files(), spark.conf.get(session.CLEANUP_KEY)
    freed = session.cut_lineage(df, free=True)
    assert not files() - before and spark.conf.get(session.CLEANUP_KEY) == set_to
    assert freed.count() == 9973
    kept: list[int] = []
    cut = maxent.cut_lineage

    def watched(df, **options):
        before = files()
        out = cut(df, **options)
        kept.append(len(files() - before))
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(maxent, "cut_lineage", watched)
        docs = spark.createDataFrame([(i, f"some words {i} and {i % 7} more of them") for i in range(50)], "doc_id long, text string")
        counts = maxent.word_counts(docs)
        assert maxent.score(docs, maxent.train(docs, counts), counts).count() == 50
    assert len(kept) >= 5 and not any(kept)


def _by_hand(tables, texts, text) -> float:
    (words, _), by_class, by_member, size = tables
    v = maxent.Vocabulary(*tables[0])
    skip, both, word, count = Counter(), Counter(), Counter(), Counter()

    def read(t):
        for slots, context, tokens in v.read(t):
            yield from zip([None, None, *tokens], [None, *tokens], tokens, slots.tolist(), context.tolist())

    for t in texts:
        for two, one, w, s, _ in read(t):
            c = v.class_[s]
            count[w] += 1
            for n, context in ((skip, two), (both, (two, one)), (word, (one, c))):
                n[context] += 1
            skip[two, c, "class"] += 1
            both[two, one, c] += 1
            word[one, c, w] += 1
    total = 0.0
    for two, one, w, s, context in read(text):
        c = v.class_[s]
        q = 10.0 ** by_class[context, c]
        if context % maxent.SECOND >= maxent.SECOND - maxent.TAIL:
            q = (skip[two, c, "class"] + maxent.PULL_SKIP * q) / (skip[two] + maxent.PULL_SKIP)
        q = (both[two, one, c] + maxent.PULL_BOTH * q) / (both[two, one] + maxent.PULL_BOTH)
        m = 10.0 ** by_member[context // maxent.SECOND, v.place[s]] if v.head[s] else (count[w] + 0.1) / 10.0 ** size[c - maxent.HEAD]
        total += math.log10(q * (word[one, c, w] + maxent.PULL_WORD * m) / (word[one, c] + maxent.PULL_WORD))
    return total


def test_word_blocks_cover_the_text():
    text = "Some  words\tin\nblocks " * 50
    got = [w for block in maxent.word_blocks(text, 40) for w in block]
    assert got == text.lower().encode().split() + [maxent.END]


def test_lines_of_other_scripts_end_sentences(spark):
    texts = ["यह एक वाक्य है।", "یہ ایک جملہ ہے۔", "هل هذه جملة؟", "这是一个句子。这是另一个", "no end here", "menu ؟x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(quality.line_fails(F.col("t")).alias("f"))
    assert [r.f for r in df.collect()] == [False, False, False, False, True, True]


def test_kept_rows_keep_columns_of_any_name(spark):
    text = " ".join(f"word{i}" for i in range(30)) + "."
    df = spark.createDataFrame([(1, text, "mine", 7, None), (2, "short", "x", 1, 1)], "doc_id long, text string, kept string, n_words int, lost_chars long")
    assert [tuple(r) for r in quality.keep_good(df).collect()] == [(1, text, "mine", 7, None)]


BIG = [(9007199254740993, "One text here."), (None, "no id"), (9007199254740995, None)]


def test_large_ids_survive_next_to_null_ids(spark):
    df = spark.createDataFrame(BIG, "doc_id long, text string").coalesce(1)
    packed = binary_output.pack_documents(df).collect()
    assert sorted(i or 0 for r in packed for i in r.doc_ids) == [0, 9007199254740993, 9007199254740995]
    counts = maxent.word_counts(df)
    scored = maxent.score(df, maxent.train(df, counts), counts).collect()
    assert sorted(r.doc_id or 0 for r in scored) == [0, 9007199254740993, 9007199254740995]


def test_bpe_keeps_columns_of_any_name(spark):
    text = "it's they'll we've " * 50
    df = spark.createDataFrame([(1, text, "a", "b")], "doc_id long, text string, _row string, _row_ string")
    for chunk, overlap in ((50, 10), (64, 5), (41, 7)):
        r = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, chunk, overlap).first()
        assert (r._row, r._row_) == ("a", "b") and r.tokens == LIBRARY.encode_ordinary(text)


def test_chunks_cut_inside_short_suffixes(spark):
    rng = np.random.default_rng(5)
    parts = ["'re", "'ll", "'ve", "'s", "we", " I", "  ", "\n", "x1", "!"]
    rows = [(i, "".join(rng.choice(parts, 40))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for overlap in (2, 4, 9):
        got = byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, 17, overlap).collect()
        assert [r.doc_id for r in got if r.tokens != LIBRARY.encode_ordinary(r.text)] == []
