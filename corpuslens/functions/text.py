"""Text expressions. All run inside the JVM except `nfc`, which has no built-in."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpuslens.functions import fixed_values as fixed

# Markup patterns, in the order in which they apply; (?U) makes \s and \S follow Unicode.
_MATH = (r"(?s)\$\$.*?\$\$", r"(?s)\\\[.*?\\\]", r"\$[^$]*?\$", r"(?s)\\\(.*?\\\)")
_UNWRAPPED = ("textbf", "textit", "emph", "underline", "text")
_DROPPED = ("cite", "ref", "label", "footnote", "url", "includegraphics")
_CONTROL = r"[\p{Cc}\p{Cf}&&[^\n\t ]]"

# Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = ("et al", "Fig", "Figs", "Eq", "Eqs", "Sec", "Ref", "Tab", "e.g", "i.e", "cf", "vs", "resp")
_DOT = "\u0001"

# Marks belong to the letter before them.
_WORD_GAP = r"[^\p{L}\p{N}\p{M}]+"


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Unicode NFC, batch by batch; already normal strings pass through."""
    return texts.map(
        lambda t: t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t)
    )


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row, however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _replace(text: Column, *rules: tuple[str, str]) -> Column:
    return reduce(lambda c, rule: F.regexp_replace(c, F.lit(rule[0]), F.lit(rule[1])), rules, text)


def strip_markup(text: Column) -> Column:
    """Remove formulas and macros, keeping the words inside formatting macros and links."""
    return _replace(
        text,
        *[(p, " ") for p in _MATH],
        *[(rf"\\{name}\{{([^}}]*)\}}", "$1") for name in _UNWRAPPED],
        (r"\\href\{[^}]*\}\{([^}]*)\}", "$1"),
        *[(rf"\\{name}\{{[^}}]*\}}", " ") for name in _DROPPED],
        (r"\\[a-zA-Z]+\b\*?", " "),
        (r"[{}]", ""),
    )


def strip_urls(text: Column) -> Column:
    return _replace(text, (r"(?U)https?://\S+", " "), (r"(?U)www\.\S+", " "))


def strip_controls(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_CONTROL), F.lit(""))


def squeeze(text: Column) -> Column:
    """Collapse every run of white space to one space and trim the ends."""
    return F.trim(F.regexp_replace(text, F.lit(r"(?U)\s+"), F.lit(" ")))


@lru_cache(1)
def _changing() -> str:
    """Pattern of the characters that a text in another form than NFC has at least one of: marks, the jamo that join a
    syllable, and characters that NFC replaces by others, found by asking it."""
    replaced = [c for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFC", chr(c)) != chr(c)]
    ranges: list[list[int]] = []
    for c in replaced:
        if ranges and c == ranges[-1][1] + 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return r"[\p{M}\x{1161}-\x{1175}\x{11A8}-\x{11C2}" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def may_change(text: Column) -> Column:
    """Whether NFC can change a text. Nothing below U+0300 can change, so most texts are told by one short look."""
    return F.regexp_like(text, F.lit("[^\\x{0}-\\x{2FF}]")) & F.regexp_like(text, F.lit(_changing()))


def composed(text: Column) -> Column:
    """NFC of a text. Only texts that it can change are handed to Python."""
    return F.coalesce(nfc(F.when(may_change(text), text)), text)


def _stripped(text: Column) -> Column:
    return strip_urls(strip_markup(F.coalesce(text, F.lit(""))))


def clean(text: Column, normalise: bool = True) -> Column:
    """Plain text of an abstract in NFC; NULL becomes the empty string. Of a whole column, `clean_text` strips each text
    once only."""
    stripped = _stripped(text)
    return squeeze(strip_controls(composed(stripped) if normalise else stripped))


def clean_text(df: DataFrame, text: str | Column, output: str = "clean", normalise: bool = True) -> DataFrame:
    """`df` with the plain text of a column. The stripped text is a column of its own while NFC looks at it."""
    column = F.col(text) if isinstance(text, str) else text
    if not normalise:
        return df.withColumn(output, clean(column, False))
    bare = df.withColumn("_stripped", _stripped(column))
    normal = bare.withColumn("_normal", nfc(F.when(may_change(F.col("_stripped")), F.col("_stripped"))))
    return normal.withColumn(output, squeeze(strip_controls(F.coalesce("_normal", "_stripped")))).drop("_stripped", "_normal")


def sentences(text: Column) -> Column:
    """Array of sentences: a stop, white space, and no known abbreviation before it."""
    names = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    guarded = F.regexp_replace(text, F.lit(rf"\b({names})\.(?=\s)"), F.lit(f"$1{_DOT}"))
    parts = F.split(guarded, r"(?<=[.!?])\s+")
    restored = F.transform(parts, lambda s: F.trim(F.translate(s, _DOT, ".")))
    return F.filter(restored, lambda s: s != "")


def unfold(df: DataFrame, array: Column, name: str, *keep, pos: str | None = None) -> DataFrame:
    """One row per element of a costly array expression.

    A plain explode makes Spark filter by the size of the array first, which computes it twice; the
    outer form with a filter behind it computes it once.
    """
    if pos is None:
        return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
    return df.select(*keep, F.posexplode_outer(array).alias(pos, name)).filter(F.col(pos).isNotNull())


def split_sentences(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per sentence with its position."""
    return unfold(df, sentences(F.col(column)), "sentence", *keep, pos="pos")


def rejoin_sentences(text: Column) -> Column:
    return F.array_join(sentences(text), " ")


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    """True when `text` holds any of the phrases."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in phrases])


def cue_sentences(text: Column, cues: Sequence[str] = fixed.LIMITATION_CUES, n: int = 3) -> Column:
    """First `n` sentences that are long enough and hold a cue, cut to snippet length."""
    parts = F.split(F.coalesce(text, F.lit("")), r"(?<=[.!?])\s+")
    trimmed = F.transform(parts, lambda s: F.trim(s))
    kept = F.filter(
        trimmed,
        lambda s: (F.length(s) >= fixed.LIMITATION_MIN_CHARS) & contains_any(F.lower(s), cues),
    )
    return F.transform(F.slice(kept, 1, n), lambda s: F.substring(s, 1, fixed.SNIPPET_CHARS))


def words(text: Column) -> Column:
    """Lower-case tokens: maximal runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _WORD_GAP), lambda t: t != "")


def content_words(text: Column) -> Column:
    """Tokens without stop words."""
    stops = list(fixed.STOP_WORDS)
    return F.filter(words(text), lambda t: ~t.isin(stops))


def normalise_entity(text: Column) -> Column:
    """Lower case, single spaces, no punctuation at either end."""
    return F.btrim(squeeze(F.lower(text)), F.lit(fixed.ENTITY_PUNCTUATION))


def query_key(text: Column) -> Column:
    """Stable key of a query text, whatever its case and spacing."""
    return F.md5(squeeze(F.lower(text)))


def is_entity(text: Column) -> Column:
    """Keeps strings that are long enough, no stop term and no padding mark."""
    low = F.lower(text)
    return (
        (F.length(text) > 2) & ~low.isin(list(fixed.ENTITY_STOP)) & ~F.startswith(low, F.lit("pad"))
    )


def json_strings(text: Column) -> Column:
    """Strings of a JSON list kept as text; NULL where the text is none."""
    return F.from_json(text, "array<string>", {"mode": "PERMISSIVE"})
