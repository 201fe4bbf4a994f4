"""Line-first cleaning: rules judge each line, failing lines go, documents that lose too much go whole.

Everything is built-in functions on one row; no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm.common import GAPS, LOWER, UPPER, ascii_lower, blank, let, table, without, words_of

SYMBOLS = "#*$%&|<>"
#: Marks that a line of prose has few of.
CLUTTER = "#*$%&|<>!~="
SEPARATORS = "|<>»›•"
#: Longest line, in characters, that set phrases are looked for in.
SHORT = 160
#: A sentence ends somewhere in the line: before white space or the line's end, or by a mark of a script without blanks.
STOP_RULE = "[.!?…؟۔।॥][\"')»”]*([\\x20\\x09-\\x0D]|\\z)|[。！？]"
MENU_RULE = (
    "^(home|menu|log ?in|log ?out|sign (in|up)|register|contact( us)?|about( us)?|search|site ?map|next|previous|share|"
    "read more|click here|back to top|skip to content)[.!>]?\\z"
)
BOILERPLATE_RULE = (
    "(all rights reserved|privacy policy|cookie policy|terms of (use|service)|enable javascript|lorem ipsum|powered by|"
    "subscribe to our|licensed under|released under the|share this (page|post|article))"
)


def repeated_words(words: Column, span: int = 8) -> Column:
    """Words that stand in a `span`-word window found at least twice in the text, the first find included.

    `span` is a power of two.
    """
    element = F.transform

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(element(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = lambda e, i: (F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"])
            return F.sort_array(element(F.filter(s, lambda e, i: F.coalesce(twice(e, i), F.lit(False))), lambda e: e["i"]))

        def total(p: Column) -> Column:
            steps = element(p, lambda x, i: F.least(F.lit(span), F.coalesce(F.get(p, i + 1) - x, F.lit(span))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(ranked, places), total)

    def doubled(k: int) -> Callable[[Column], Column]:
        return lambda h: F.zip_with(h, F.slice(h, F.lit(k + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))

    def whole(h: Column, n: int) -> Column:
        """Hashes of the windows of n words that lie in the text."""
        return F.slice(h, F.lit(1), F.size(h) - (n - 1))

    def found(half: Column) -> Column:
        """From the windows of half the span: where none of these repeats, no window does."""
        full = let(let(half, doubled(span // 2)), lambda h: whole(h, span))
        return F.when(F.size(F.array_distinct(half)) == F.size(half), F.lit(0).cast("long")).otherwise(let(full, covered))

    def count(w: Column) -> Column:
        hashes, reach = element(w, lambda x: F.xxhash64(x)), 1
        while 2 * reach < span:  # of one word, two, four and so on
            hashes, reach = let(hashes, doubled(reach)), 2 * reach
        return F.when(F.size(w) <= span, F.lit(0).cast("long")).otherwise(let(hashes, found))

    return let(words, count)


def line_fails(line: Column) -> Column:
    """Punctuation: no sentence end, or clutter. Navigation: separators or a menu entry. Boilerplate: a set phrase in a
    short line. Most lines hold none of the counted marks, which one look tells."""
    plain = F.btrim(ascii_lower(line), F.lit(GAPS))
    count = lambda characters: F.length(line) - F.length(without(line, characters))
    spots = count(" ") + 1
    marked = F.regexp_like(line, F.lit(f"[{CLUTTER}{SEPARATORS}]"))
    cluttered = (2 * count(CLUTTER) > spots) | ((3 <= count(SEPARATORS)) & (4 * count(SEPARATORS) >= spots))
    phrase = F.regexp_like(plain, F.lit(MENU_RULE)) | F.regexp_like(plain, F.lit(BOILERPLATE_RULE))
    return ~F.regexp_like(line, F.lit(STOP_RULE)) | (marked & cluttered) | ((F.length(line) <= SHORT) & phrase)


def clean_lines(documents: DataFrame, max_lost_percent: int = 40, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """Every row with its measures, the text without failing lines, and the verdict.

    `kept` needs the base rules (enough words, few repeated) and at most `max_lost_percent` of the
    characters in words lost with failing lines. A null text counts as empty: no words, not kept. Rows are
    judged alone, so ties, repeated rows and null ids change nothing; an empty table gives none. Own columns
    of the same names are replaced, others stay.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = lambda x: F.filter(F.split(x, "\n", -1), lambda y: ~blank(y))
    chars = lambda x: F.length(without(x, GAPS)).cast("long")
    # One struct a row, so that words and lines are made once.
    measured = documents.withColumn("_m", let(text, lambda text: F.struct(
        let(words_of(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")
        )).alias("w"),
        chars(text).alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines(text), lambda x: F.struct(
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            let(F.filter(x, lambda y: ~line_fails(y)), lambda good: F.struct(
                F.concat_ws("\n", good).alias("text"),
                F.when(F.size(good) == F.size(x), F.lit(0).cast("long")).otherwise(
                    chars(F.concat_ws("\n", x)) - chars(F.concat_ws("\n", good))
                ).alias("lost"),
            )).alias("good"),
        )).alias("l"),
    )))
    judged = measured.withColumns({
        "n_words": F.col("_m.w.n_words"), "word_chars": F.col("_m.word_chars"), "n_symbols": F.col("_m.n_symbols"),
        "n_dup_lines": F.col("_m.l.n_dup_lines"), "n_repeat_words": F.col("_m.w.n_repeat_words"), "clean_text": F.col("_m.l.good.text"),
        "lost_chars": F.col("_m.l.good.lost"),
    }).drop("_m")
    return judged.withColumn(
        "base_failed",
        (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")),
    ).withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost_percent * F.col("word_chars")))


def keep_good(documents: DataFrame) -> DataFrame:
    """Rows that `clean_lines` keeps, whole; columns of any name stay as they are. Null, empty and blank texts go, repeated
    rows and ties are judged alike, long texts whole; an empty table gives none."""
    rows = documents.select("text", F.struct(*documents.columns).alias("row"))
    return clean_lines(rows).filter("kept").select("row.*")


COLUMNS = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars",
)


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document. Phrases are looked for in lines of up to `SHORT` characters, which is part
    of the rule; everything else reads whole lines. Nulls and other odd rows as in `clean_lines`."""
    return clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*COLUMNS)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_GAPS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
_PLAIN = f"trim(translate(line, '{UPPER}', '{LOWER}'), {_GAPS})"
_COUNT = "(length(line) - length(translate(line, {}, '')))"
_SPOTS = f"({_COUNT.format("' '")} + 1)"
SQL = f"""with docs as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
split as (select rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w from docs),
tokens as (select rid, unnest(range(1, len(w) - 6)) as i, w from split where len(w) > 8),
windows as (select rid, i, w[i:i + 7] as v from tokens),
twice as (select rid, i from windows qualify count(*) over (partition by rid, v) > 1),
spread as (select distinct rid, i + k as p from twice, range(0, 8) r(k)),
repeats as (select rid, count(*) as n_repeat_words from spread group by 1),
lines as (select rid, unnest(string_split(text, chr(10))) as line from docs),
worded as (select * from lines where translate(line, {_GAPS}, '') <> ''),
judged as (select rid, line, length(translate(line, {_GAPS}, '')) as chars,
    not regexp_matches(line, {_text(STOP_RULE)}) or 2 * {_COUNT.format(_text(CLUTTER))} > {_SPOTS}
    or ({_COUNT.format(_text(SEPARATORS))} >= 3 and 4 * {_COUNT.format(_text(SEPARATORS))} >= {_SPOTS})
    or length(line) <= {SHORT} and (regexp_matches({_PLAIN}, {_text(MENU_RULE)}) or regexp_matches({_PLAIN}, {_text(BOILERPLATE_RULE)}))
    as bad
    from worded),
sums as (select rid, count(*) - count(distinct line) as n_dup_lines,
    sum(case when bad then chars else 0 end)::bigint as lost_chars from judged group by 1),
base as (select doc_id, len(w) as n_words, length(translate(text, {_GAPS}, '')) as word_chars,
    length(text) - length(translate(text, '{SYMBOLS}', '')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(lost_chars, 0) as lost_chars
    from docs join split using (rid) left join sums using (rid) left join repeats using (rid)),
failed as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base)
select {', '.join(c for c in COLUMNS if c != 'kept')},
    not base_failed and 100 * lost_chars <= 40 * word_chars as kept from failed"""
