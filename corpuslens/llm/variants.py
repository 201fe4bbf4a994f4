"""Spelling variants: words that differ by one inserted, deleted or replaced code point, by prefix-suffix tiles.

Two words whose longer has m code points are one edit apart just if their common prefix and common suffix reach m - 1
together. So they share the first m // 2 code points or the last m - m // 2, and Spark deals each word to four groups: as the
longer and as the shorter word of a pair, by prefix and by suffix. A group is cut into tiles, and every pair of tiles is
one piece of work of bounded size: two padded matrices of code points, compared column by column from both ends. What leaves
a pair of tiles is a count and the best partner of each word, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.common import LOWER, UPPER, ascii_lower, table
from corpuslens.session import cut_lineage

LETTERS = "[a-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: One run in this many loses a letter.
DAMAGE = 97
#: Words of a tile.
TILE = 1024


def vocabulary(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of all texts with the fixed damage, of enough letters and occurrences.

    A null text has no words; a null id counts as empty text. Repeated rows count as often as they stand.
    """
    runs = F.filter(
        F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(LETTERS), F.lit(0)), lambda r: F.length(r) >= least_length
    )
    found = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    mark = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (mark % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = found.select(F.when(mark % DAMAGE == 0, less).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") >= least_count
    )


def _shares(word: Column) -> Column:
    """The groups of a word: longest length of the pairs there, side, and the shared part."""
    n = F.length(word)
    out = []
    for m in (n, n + 1):
        half = F.floor(m / 2).cast("int")
        out += [
            F.struct(m.alias("m"), F.lit(False).alias("tail"), F.substr(word, F.lit(1), half).alias("part")),
            F.struct(m.alias("m"), F.lit(True).alias("tail"), F.right(word, m - half).alias("part")),
        ]
    return F.array(*out)


def tiled(words: DataFrame, tile: int = TILE) -> DataFrame:
    """Each word once for every pair of tiles it is compared in: group, tiles a <= b, and its own tile."""
    rows = words.select("word", "n", F.inline(_shares(F.col("word"))))
    keys = ["m", "tail", "part"]
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.count_if(F.length("word") == F.col("m")).alias("long"))
    live = groups.filter("size > 1 and long > 0").select(*keys, F.ceil(F.col("size") / tile).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    spread = rows.join(live, keys).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return spread.select(
        *keys, F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") <= F.col("other")).alias("first"), "word", "n"
    )


# One pair of tiles ------------------------------------------------------------------------------------------


def matrix(words: list[str], width: int, right: bool) -> np.ndarray:
    """Code points, a row a word, padded by zeros to `width` at the end or (`right`) at the start."""
    rows = [w.rjust(width, "\0") for w in words] if right else words
    codes = np.array(rows, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width)
    high = int(codes.max(initial=0))
    return codes.astype(np.uint8 if high < 256 else np.uint16 if high < 65536 else np.uint32)


def common(a: np.ndarray, b: np.ndarray, known: int = 0) -> np.ndarray:
    """Length of the common start of each row of `a` and each of `b`, of which the first `known` columns are the same."""
    run = np.ones((len(a), len(b)), bool)
    out = np.full((len(a), len(b)), known, np.uint16)
    for k in range(known, a.shape[1]):
        run &= a[:, k, None] == b[None, :, k]
        if not run.any():
            break
        out += run
    return out


def single_edits(a: list[str], b: list[str], m: int, tail: bool, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of words one edit apart, the longer of `m` code points, which share their first m // 2 code points or
    (`tail`) the others. A pair that shares both counts where the first are shared. No word of `a` is one of `b`."""
    half = m // 2
    known, back = (0, m - half) if tail else (half, 0)
    heads, tails = [matrix(x, m, False) for x in (a, b)], [matrix(x, m, True)[:, ::-1] for x in (a, b)]
    size = np.array([len(w) for w in b])
    found = []
    for i in range(0, len(a), block):
        for j in range(0, len(b), block):
            p = common(heads[0][i : i + block], heads[1][j : j + block], known)
            s = common(tails[0][i : i + block], tails[1][j : j + block], back)
            near = p + s >= m - 1
            if tail:
                near &= p < half
            near &= np.maximum(np.array([len(w) for w in a[i : i + block]])[:, None], size[None, j : j + block]) == m
            x, y = np.nonzero(near)
            found.append((x + i, y + j))
    return tuple(np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))


def partners(a: tuple[list, list], b: tuple[list, list] | None, m: int, tail: bool) -> Iterator[tuple[str, int, str, int]]:
    """(word, number of near words, the best of them, its n) of a tile against another, or against itself."""
    left = sorted(zip(*a, strict=True))
    right = left if b is None else sorted(zip(*b, strict=True))
    i, j = single_edits([w for w, _ in left], [w for w, _ in right], m, tail)
    if b is None:
        apart = i != j
        i, j = i[apart], j[apart]
    sides = [(left, right, i, j)] if b is None else [(left, right, i, j), (right, left, j, i)]
    for own, other, x, y in sides:
        n = np.array([c for _, c in other], np.int64)
        order = np.lexsort((y, -n[y], x))  # words are sorted, so of equal n the least comes first
        x, y = x[order], y[order]
        for at, size in zip(*np.unique(x, return_index=True), strict=True) if len(x) else ():
            yield own[at][0], int(np.searchsorted(x, at, side="right") - size), other[y[size]][0], int(n[y[size]])


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, form, form_n) of each word with a near one: `form` has the largest n, ties to the smallest word."""
    keys = ["m", "tail", "part", "a", "b"]
    rows = tiled(words, tile)
    names = [*keys, "first", "word", "n"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, tiles, out = None, ([], []), []

        def done() -> None:
            m, tail, _, a, b = here
            first, second = (tuple(zip(*t, strict=True)) if t else ((), ()) for t in tiles)
            if a == b:
                out.extend(partners(first, None, m, tail))
            elif first[0] and second[0]:
                out.extend(partners(first, second, m, tail))

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                names=["word", "near", "form", "form_n"],
            )

        for batch in batches:
            for *key, first, word, n in zip(*(batch[c].to_pylist() for c in names), strict=True):
                if key != here:
                    if here:
                        done()
                    here, tiles = key, ([], [])
                tiles[0 if first else 1].append((word, n))
            if out:
                yield batch_of(out)
                out.clear()
        if here:
            done()
        if out:
            yield batch_of(out)

    found = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "word string, near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.minus")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last form on the way. Each step at least doubles n, so ways are short, and
    each round doubles the steps taken; it ends when none goes further."""
    now = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        now = cut_lineage(now.select("word", "root").join(on, "root", "left").select(
            "word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")
        ))
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def spelling_variants(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of `words(word, n)`, whose words are distinct and not null.

    Two words are near if one code point more, less or other makes one of the other. `form` is the near word of largest n
    (ties: the smallest in code-point order) if that is at least twice the word's own; `root` follows forms to the last,
    and is the word itself without one. A word without near ones has n_near 0. An empty table gives none. `words` must
    have two code points or more to be compared; other columns are not carried.
    """
    words = cut_lineage(words.select("word", F.col("n").cast("long").alias("n")))
    near = cut_lineage(near_words(words, tile))
    known = cut_lineage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(F.col("form_n") >= 2 * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")],
    ))
    return known.join(roots(known.filter("form is not null")), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents. Nulls, repeated rows, ties and empty tables as in
    `vocabulary` and `spelling_variants`; texts of any length are read whole."""
    out = spelling_variants(vocabulary(table(spark, sf_dir, "documents")))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


#: crc32 by its table, which SQL lacks.
CRC_SQL = """crc_table as materialized (select list(c order by n) as crc_of from (select n, list_reduce(list_prepend(n, range(0, 8)),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(0, 256) t(n)))"""


def crc_sql(codes: str) -> str:
    """crc32 of a list of bytes; `crc_of` must be in scope."""
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, crc_of[xor(c & 255, b) + 1])), 4294967295)"


_BYTES = """flatten(list_transform(string_split(id || ':' || run, ''), lambda ch: case when unicode(ch) < 128
    then [unicode(ch)::bigint] else [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)] end))"""
SQL = f"""with recursive {CRC_SQL},
runs as (select coalesce(doc_id::varchar, '') as id,
    unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) as run from documents),
known as (select id, run, count(*) as c from runs where length(run) >= {LEAST_LENGTH} group by 1, 2),
marked as (select run, c, {crc_sql(_BYTES)} as h from known, crc_table),
words as (select case when h % {DAMAGE} = 0 then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, c from marked),
vocab as materialized (select word, sum(c)::bigint as n from words where length(word) >= {LEAST_LENGTH} group by 1
    having sum(c) >= {LEAST_COUNT}),
spots as (select word, n, unnest(range(1, length(word) + 1)) as i from vocab),
lacking as (select word, n, i, word[1:i - 1] || word[i + 1:] as less from spots),
pairs as materialized (select a.word, b.word as other, b.n from lacking a join lacking b on a.less = b.less and a.i = b.i and a.word <> b.word
    union select a.word, v.word, v.n from lacking a join vocab v on a.less = v.word
    union select v.word, a.word, a.n from lacking a join vocab v on a.less = v.word),
best as (select word, count(*) as n_near, first(other order by n desc, other) as form, max(n) as form_n from pairs group by 1),
forms as materialized (select word, n, coalesce(n_near, 0) as n_near, case when form_n >= 2 * n then form end as form,
    case when form_n >= 2 * n then form_n end as form_n from vocab left join best using (word)),
way as (select word, word as root from forms union all
    select way.word, f.form from way join forms f on f.word = way.root where f.form is not null),
last as (select way.word, root from way join forms f on f.word = way.root where f.form is null)
select word, form, root, n, n_near, form_n from forms join last using (word)"""
