"""What the operators share: tables, the word rule, folds and local bindings inside a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space between words: blank and U+0009 to U+000D.
GAPS = " \t\n\x0b\x0c\r"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once a row, however often and deep `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def swap(text: Column, characters: str, by: str) -> Column:
    """Each of a few characters replaced; searched one by one, which is several times faster than `translate`."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def without(text: Column, characters: str) -> Column:
    return swap(text, characters, "")


def blank(text: Column) -> Column:
    return F.btrim(text, F.lit(GAPS)) == ""


def words_of(text: Column) -> Column:
    """Words of a text; none for a null or blank one."""
    return F.array_remove(F.split(swap(F.coalesce(text, F.lit("")), GAPS[1:], " "), " "), "")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds
