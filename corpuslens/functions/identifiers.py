"""Keys, dates and months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed

UNKNOWN_MONTH = "unknown"


def non_empty(text: Column) -> Column:
    """NULL instead of the empty string, so that coalesce can pass over it."""
    return F.nullif(text, F.lit(""))


def valid_key(key: Column) -> Column:
    return key.isNotNull() & (key != "")


def strip_version(paper_id: Column) -> Column:
    """Drop a trailing version mark such as v2."""
    return F.regexp_replace(paper_id, F.lit(r"v\d+$"), F.lit(""))


def is_preprint_id(paper_id: Column, versioned: bool = False) -> Column:
    return paper_id.rlike(fixed.PREPRINT_ID_VERSIONED if versioned else fixed.PREPRINT_ID)


def preprint_id(paper_id: Column) -> Column:
    return F.when(is_preprint_id(paper_id), paper_id)


def corpus_id(paper_id: Column) -> Column:
    return F.when(~is_preprint_id(paper_id), paper_id)


def lookup_id(paper_id: Column) -> Column:
    """Form of an id that a batch lookup expects."""
    key = F.trim(paper_id)
    return F.when(is_preprint_id(key, versioned=True), F.concat(F.lit("ArXiv:"), key)).otherwise(key)


def to_day(text: Column) -> Column:
    """Date of an ISO string; a lone year is its first day, anything else unreadable is NULL."""
    return text.try_cast("date")


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_partition(day: Column) -> Column:
    return F.coalesce(month_of(day), F.lit(UNKNOWN_MONTH))


def second_precision(ts: Column) -> Column:
    """ISO text of a timestamp without fraction and offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
