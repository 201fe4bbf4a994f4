"""Incremental runs over a landing folder with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuslens.functions import identifiers as ids
from corpuslens.operators import consolidate, search


def stream_json(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true").json(path)
    )


def stream_parquet(spark: SparkSession, folder: str, files: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(folder)


def usable_records(stream: DataFrame, at: str = "ingested_at", key: str = "paper_id") -> DataFrame:
    """Records with a valid key; an unreadable time is NULL and costs its own value only."""
    return stream.withColumn(at, F.col(at).try_cast("timestamp")).filter(ids.valid_key(F.col(key)))


def ingest(
    stream: DataFrame, checkpoint: str, merge: Callable[[DataFrame, int], None]
) -> StreamingQuery:
    """Run `merge` on each batch of new records until the folder is used up.

    `merge` must give the same result when a batch is repeated after a failure, as an overwrite of
    the touched partitions does.
    """
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(merge).trigger(availableNow=True).start()
    )


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Sink with one folder per batch, replaced when that batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


#: Parts of what is stored of a batch, by a hash of the key.
BUCKETS = 32


def store_new(path: str, at: str = "ingested_at", key: str = "paper_id") -> Callable[[DataFrame, int], None]:
    """Sink that keeps the earliest record of each key in a batch, unless an earlier batch has stored the key.

    What is stored decides, not a watermark, so a backfill of any age is taken in and no key is forgotten. Of earlier
    batches only the keys are read, and only in the parts that keys of this batch fall into. A repeated batch replaces
    its own folder; records without a time come last.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        part = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")
        rows = consolidate.first_row(batch, key, F.col(at).asc_nulls_last(), F.xxhash64(*batch.columns)).withColumn("bucket", part)
        if batch_id > 0:
            # At most BUCKETS numbers, known before the scan starts.
            touched = batch.select(part.alias("bucket")).agg(F.collect_set("bucket")).scalar()
            stored = batch.sparkSession.read.schema(f"`{key}` string, batch long, bucket int").option("basePath", path).parquet(path)
            known = stored.filter((F.col("batch") < batch_id) & F.array_contains(touched, F.col("bucket")))
            rows = rows.join(known.select(key, "bucket"), [key, "bucket"], "left_anti")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{path}/batch={batch_id}")

    return write


def daily_counts(rows: DataFrame, at: str = "ts", *keys: str) -> DataFrame:
    """Records per day and key."""
    return rows.groupBy(F.to_date(at).alias("day"), *keys).agg(F.count(F.lit(1)).alias("records"))


def latest_counts(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """Counts over all batches so far."""
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.groupBy(*keys).agg(F.sum("records").alias("records"))


def run_daily_counts(stream: DataFrame, checkpoint: str, path: str, at: str = "ts", *keys: str) -> StreamingQuery:
    """Write what each batch adds to the counts; `latest_counts` adds it up.

    Additions of any age count, since no day is ever closed, and a batch reads nothing but its own rows. A repeated
    batch replaces its own additions.
    """
    add = append_batches(path)
    return ingest(stream, checkpoint, lambda batch, batch_id: add(daily_counts(batch, at, *keys), batch_id))


def refresh_index(papers: Callable[[], DataFrame], index: str, stem: bool = True) -> Callable[[DataFrame, int], None]:
    """Batch function that rebuilds the postings of the months in which papers arrived.

    The list of months is as short as the history of the corpus.
    """

    def refresh(batch: DataFrame, batch_id: int) -> None:
        months = [r[0] for r in batch.select("ingest_year_month").distinct().collect()]
        if months:
            search.build_index(papers(), index, months, stem)

    return refresh
