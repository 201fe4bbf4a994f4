"""One record per paper from several sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import identifiers as ids

FIRST_KNOWN = (
    "title", "abstract", "authors", "submitted_date", "updated_date", "primary_category",
    "categories", "source", "s2_paper_id",
)
LARGEST = ("citation_count", "reference_count", "influential_citation_count")


def _rank(source: Column, sources: Sequence[str]) -> Column:
    """Place of a source in the order of trust; unknown sources come last."""
    rank = F.lit(99)
    for place, name in reversed(list(enumerate(sources))):
        rank = F.when(source == name, F.lit(place)).otherwise(rank)
    return rank


def merge_sources(
    *frames: DataFrame, sources: Sequence[str] = fixed.SOURCES,
    first_known: Sequence[str] = FIRST_KNOWN, largest: Sequence[str] = LARGEST,
) -> DataFrame:
    """Per paper: the first known value by trust, the greatest count, the earliest intake.

    Records of one source are ordered by intake time and then by the value itself, so the result
    depends neither on partitioning nor on row order. The aggregates combine on the map side, which
    keeps the shuffle at one row per key and input partition even where one key fills the input.
    """
    rows = frames[0]
    for other in frames[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    rows = rows.filter(ids.valid_key(F.col("paper_id")))
    for name in (*first_known, *largest, "ingested_at"):
        if name not in rows.columns:
            raise ValueError(f"no source has the column {name}")
    rank = _rank(F.col("source"), sources)

    def first(name: str) -> Column:
        ordered = F.struct(rank.alias("rank"), F.col("ingested_at"), F.col(name).alias("value"))
        return F.min(F.when(F.col(name).isNotNull(), ordered))["value"].alias(name)

    merged = rows.groupBy("paper_id").agg(
        *[first(c) for c in first_known],
        *[F.max(c).alias(c) for c in largest],
        F.min("ingested_at").alias("ingested_at"),
    )
    return merged.select("paper_id", *[c for c in frames[0].columns if c != "paper_id"])


def curate(merged: DataFrame) -> DataFrame:
    """Columns of the papers table, with room for topics and entities."""
    day = ids.to_day(F.col("submitted_date"))
    return merged.select(
        "paper_id", "title", "abstract", "authors",
        day.alias("submitted_date"),
        ids.to_day(F.col("updated_date")).alias("updated_date"),
        "primary_category", "categories", "citation_count", "reference_count",
        "influential_citation_count",
        F.lit(None).cast("int").alias("topic_cluster_id"),
        F.lit(None).cast("string").alias("topic_cluster"),
        F.lit(None).cast("float").alias("umap_x"),
        F.lit(None).cast("float").alias("umap_y"),
        F.lit(None).cast("array<string>").alias("methods"),
        F.lit(None).cast("array<string>").alias("datasets"),
        F.lit(None).cast("array<string>").alias("tasks"),
        "source",
        F.col("ingested_at").try_cast("timestamp").alias("ingested_at"),
        "s2_paper_id",
        ids.month_partition(day).alias("ingest_year_month"),
    )


def dedup_edges(edges: DataFrame) -> DataFrame:
    """One row per pair; the smallest source name stands for it.

    The names, of which there are as many as sources, are listed once in order, so that each pair's aggregate holds a
    number and hashes instead of sorting all edges.
    """
    names = edges.agg(F.array_sort(F.collect_set("source"))).scalar()
    place = F.array_position(names, F.col("source")).cast("int")
    least = edges.groupBy("citing_id", "cited_id").agg(F.min(place).alias("place"))
    return least.select("citing_id", "cited_id", F.get(names, F.col("place") - 1).alias("source"))


def first_row(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """First row of each key. Spark limits each task to one row per key before the shuffle, so a key
    with very many copies stays cheap."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def one_per_paper(df: DataFrame, *order: Column) -> DataFrame:
    return first_row(df, "paper_id", *order)


def dedup_by_source(
    df: DataFrame, sequence: Column, sources: Sequence[str] = fixed.SOURCES
) -> DataFrame:
    """One record per paper: the most trusted source, and its first record by `sequence`."""
    kept = df.filter(ids.valid_key(F.col("paper_id")))
    return first_row(kept, "paper_id", _rank(F.col("source"), sources), sequence)


def longest_fulltext(fulltext: DataFrame) -> DataFrame:
    """The longest body of each paper; then the latest, then the smallest digest."""
    return first_row(
        fulltext.filter(ids.valid_key(F.col("paper_id"))),
        "paper_id",
        F.length("full_text").desc(), F.col("ingested_at").desc(), F.md5("full_text"),
    )


def long_enough(
    df: DataFrame, column: str = "abstract", least: int = 100
) -> DataFrame:
    """Papers whose text has the least length after trimming."""
    return df.filter(F.length(F.trim(column)) >= least)


def skip_flag(df: DataFrame, column: str, least: int = 50, flag: str = "skip_ner") -> DataFrame:
    """Mark texts too short for entity work; NULL counts as empty."""
    return df.withColumn(flag, F.length(F.trim(F.coalesce(column, F.lit("")))) < least)


def corpus_size_check(df: DataFrame, least: int = 50) -> DataFrame:
    """Row count of a corpus and whether it suffices for topic work."""
    return df.agg(F.count(F.lit(1)).alias("papers")).withColumn("enough", F.col("papers") >= least)


def lookback(
    df: DataFrame, as_of: Column, days: int, cap: int, category: str = "primary_category"
) -> DataFrame:
    """The newest papers of each category since `as_of` minus `days`, at most `cap` each."""
    recent = df.filter(F.col("submitted_date") >= F.date_sub(as_of, days))
    order = Window.partitionBy(category).orderBy(F.col("submitted_date").desc(), F.col("paper_id"))
    return recent.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= cap)


def source_mix(papers: DataFrame) -> DataFrame:
    """Papers of each source and how many carry topics, outlier marks and entities."""
    return papers.groupBy("source").agg(
        F.count(F.lit(1)).alias("papers"),
        F.count("topic_cluster").alias("with_topic"),
        F.count_if(F.col("topic_cluster_id") == -1).alias("outliers"),
        F.count("methods").alias("with_methods"),
    )


def ingest_summary(papers: DataFrame, *keys: str) -> DataFrame:
    return papers.groupBy(*keys).agg(F.count(F.lit(1)).alias("papers"))


def new_ids(landed: DataFrame, day: Column) -> DataFrame:
    """Distinct ids landed on one day, over all categories."""
    return landed.filter(F.col("date") == day).select("paper_id").distinct()


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table, counted side by side."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionAll(other)
    return result
