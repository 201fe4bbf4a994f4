"""Sinks: landing files, curated tables, search exports, runs and stored vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpuslens import schemas
from corpuslens.functions import identifiers as ids
from corpuslens.session import working_path

PARTITIONED = {"papers": "ingest_year_month"}

PAPER_DOCUMENT = (
    "paper_id", "title", "abstract", "authors", "submitted_date", "updated_date", "primary_category",
    "categories", "citation_count", "reference_count", "influential_citation_count",
    "topic_cluster_id", "topic_cluster", "umap_x", "umap_y", "methods", "datasets", "tasks", "source",
    "ingested_at",
)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def write_raw(df: DataFrame, base: str) -> None:
    """Append JSON lines below source/category/date. The rows of a folder are gathered first, so that a
    batch adds few files to it; a folder that gets most rows is split over several tasks."""
    folders = ["source", "category", "date"]
    df.hint("rebalance", *folders).write.partitionBy(*folders).mode("append").json(base)


def create_tables(spark: SparkSession, database: str, location: str, names: Sequence[str] | None = None) -> None:
    """Database and curated tables, each in its own folder below `location`."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name in names or schemas.TABLES:
        part = f"PARTITIONED BY ({PARTITIONED[name]})" if name in PARTITIONED else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schemas.TABLES[name]}) USING parquet {part} "
            f"OPTIONS (compression 'snappy') LOCATION '{location}/{name}'"
        )


def write_papers(df: DataFrame, table: str, key: str = "ingest_year_month") -> None:
    """Replace the months that `df` holds and keep all others.

    The rebalance hint gathers the rows of a month, and splits a month that holds most rows over
    several tasks at run time.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns).hint("rebalance", key)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def write_flat(df: DataFrame, table: str) -> None:
    """Replace a whole unpartitioned table."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=True)


def replace_columns(df: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """`df` with `columns` taken from `updates`; rows without an update get NULL."""
    order = [c for c in df.columns if c not in columns]
    joined = df.drop(*columns).join(updates.select(key, *columns), key, "left")
    return joined.select(*order, *columns)


def rewrite_table(spark: SparkSession, table: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Replace a table by a function of itself, through a copy in the shared folder.

    The copy is complete before the table is touched, and only removed after the swap.
    """
    staged = working_path(spark, "stage")
    columns = spark.table(table).columns
    partition = PARTITIONED.get(table.split(".")[-1])
    try:
        change(spark.table(table)).select(*columns).write.parquet(staged)
        fresh = spark.read.parquet(staged).select(*columns)
        if partition:
            write_papers(fresh, table, partition)
        else:
            write_flat(fresh, table)
    finally:
        path, fs = _fs(spark, staged)
        fs.delete(path, True)


def export_search_docs(papers: DataFrame, month: str | None = None) -> DataFrame:
    """Search documents of all papers, or of one month, which prunes to its partition."""
    rows = papers if month is None else papers.filter(F.col("ingest_year_month") == month)
    return rows.select(*PAPER_DOCUMENT).withColumn(
        "ingested_at", ids.second_precision(F.col("ingested_at"))
    )


def export_fulltext_docs(fulltext: DataFrame, day: str | None = None) -> DataFrame:
    """Full-text documents, or those taken in on one day, midnight to midnight."""
    at = F.col("ingested_at").try_cast("timestamp")
    rows = fulltext
    if day is not None:
        start = F.lit(day).cast("date")
        rows = rows.filter((at >= start.cast("timestamp")) & (at < F.date_add(start, 1).cast("timestamp")))
    return rows.select(
        "paper_id", "arxiv_id", "corpusid", "doi", "full_text",
        F.coalesce("sections", F.array().cast(schemas.SECTIONS)).alias("sections"),
        ids.second_precision(at).alias("ingested_at"),
    )


def write_docs(docs: DataFrame, path: str) -> dict[str, int]:
    """Write documents as JSON lines and report how many were read and how many lines the files hold."""
    seen = Observation()
    docs.observe(seen, F.count(F.lit(1)).alias("total_read")).write.mode("overwrite").json(path)
    return {"total_read": seen.get["total_read"], "total_written": docs.sparkSession.read.text(path).count()}


def save_run(df: DataFrame, base: str, run_id: str) -> None:
    """Keep one run apart from others; saving the same run again replaces it."""
    df.withColumn("run_id", F.lit(run_id)).write.option(
        "partitionOverwriteMode", "dynamic"
    ).mode("overwrite").partitionBy("run_id").parquet(base)


def load_run(spark: SparkSession, base: str, run_id: str) -> DataFrame:
    rows = spark.read.option("basePath", base).parquet(f"{base}/run_id={run_id}")
    return rows.drop("run_id")


def list_runs(spark: SparkSession, base: str) -> list[str]:
    """Run ids, newest first, from the folder names alone."""
    pattern, fs = _fs(spark, f"{base}/run_id=*")
    found = fs.globStatus(pattern) or []
    return sorted((s.getPath().getName().split("=", 1)[1] for s in found), reverse=True)


def embedding_store(
    texts: DataFrame, path: str, model: str, dims: int,
    encode: Callable[[DataFrame], DataFrame], key: str = "paper_id", text: str = "text",
) -> DataFrame:
    """Vectors of all texts: stored ones are reused, only new or changed texts are encoded.

    `encode` adds an `embedding` column to (key, text). A stored vector of another length counts as
    absent, so a changed model size is encoded afresh.
    """
    spark = texts.sparkSession
    wanted = texts.select(key, text, F.md5(text).alias("text_md5"))
    ids_ = [key, "text_md5"]

    def stored() -> DataFrame:
        return spark.read.parquet(path).filter(
            (F.col("model") == model) & (F.size("embedding") == dims)
        ).select(*ids_, "embedding")

    missing = wanted.join(stored(), ids_, "left_anti") if path_exists(spark, path) else wanted
    encode(missing).select(
        key, "text_md5", F.col("embedding").cast("array<float>"), F.lit(model).alias("model")
    ).write.mode("append").partitionBy("model").parquet(path)
    return wanted.select(*ids_).join(stored(), ids_, "inner").select(key, "embedding")
