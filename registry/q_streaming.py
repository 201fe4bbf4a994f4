"""Structured Streaming over the given files, run until they are used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import search
from corpuslens.streaming import incremental as inc
from registry.core import query
from registry.q_search import SHOWN_SQL, TWO_FIELDS, bm25_sql, shown

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(v):
    rows = inc.stream_parquet(v.spark, v.dir, "events.parquet", EVENTS)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


@query(sql="select cast(ts as date) as day, event_type, count(*) as records from events group by 1, 2")
def stream_daily_counts(v):
    out = v.scratch("daily")
    inc.run_daily_counts(events(v), v.scratch("checkpoint"), out, "ts", "event_type").awaitTermination()
    return inc.latest_counts(v.spark, out, "day", "event_type")


@query(sql="""select day, lang, count(*) as records from (select lang, date '2024-05-01' + cast(doc_id % 40 as int) as day
    from documents where doc_id % 3 = 0 union all
    select lang, date '2019-05-01' + cast(doc_id % 40 as int) from documents) group by 1, 2""")
def stream_counts_after_backfill(v):
    """Records of years long gone arrive after the newest and count like any other."""
    landing, out, checkpoint = v.scratch("landing"), v.scratch("daily"), v.scratch("checkpoint")
    docs = v.table("documents").select("doc_id", "lang")
    for part, year in ((docs.filter("doc_id % 3 = 0"), 2024), (docs, 2019)):
        day = F.date_add(F.lit(f"{year}-05-01").cast("date"), (F.col("doc_id") % 40).cast("int"))
        part.select("lang", day.cast("timestamp").alias("ts")).write.mode("append").parquet(landing)
        stream = v.spark.readStream.schema("lang string, ts timestamp").option("maxFilesPerTrigger", 3).parquet(landing)
        inc.run_daily_counts(stream, checkpoint, out, "ts", "lang").awaitTermination()
    return inc.latest_counts(v.spark, out, "day", "lang")


@query(sql="select distinct cast(user_id as varchar) as paper_id from events")
def stream_fresh_records(v):
    out = v.scratch("fresh")
    rows = events(v).select(F.col("user_id").cast("string").alias("paper_id"), F.col("ts").alias("ingested_at"))
    inc.ingest(inc.usable_records(rows), v.scratch("checkpoint"), inc.store_new(out)).awaitTermination()
    return v.spark.read.parquet(out).select("paper_id")


#: Bytes of text that land in four files.
LANDED_BYTES = 1 << 29


@query(sql="""select cast(doc_id as varchar) as paper_id, length(text) as chars, lang as primary_category from documents""")
def stream_landing_files(v):
    """Landed JSON files arrive in batches and are merged by key. Small tables land in four files, larger ones in more."""
    landing, out = v.scratch("landing"), v.scratch("merged")
    documents = v.table("documents")
    files = 4 * (1 + (documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // LANDED_BYTES)
    documents.select(
        F.col("doc_id").cast("string").alias("paper_id"), "text", "lang",
        F.expr("timestampadd(SECOND, cast(doc_id % 1000 as int), timestamp '2024-01-01 00:00:00')").alias("ingested_at"),
    ).repartition(files).write.json(landing)
    stream = inc.stream_json(
        v.spark, landing, "paper_id string, text string, lang string, ingested_at string", files_per_batch=files // 2
    )
    inc.ingest(inc.usable_records(stream), v.scratch("checkpoint"), inc.store_new(out)).awaitTermination()
    return v.spark.read.parquet(out).select(
        "paper_id", F.length("text").alias("chars"), F.col("lang").alias("primary_category")
    )


@query(sql="""select cast(doc_id as varchar) as paper_id, case when doc_id % 3 = 0 then 2024 else 2019 end as year, lang
    from documents""")
def stream_backfill(v):
    """Years after the newest records arrived, a backfill brings old ones, and some keys once more."""
    landing, out, checkpoint = v.scratch("landing"), v.scratch("merged"), v.scratch("checkpoint")
    docs = v.table("documents").select(F.col("doc_id").cast("string").alias("paper_id"), "lang", "doc_id")
    schema = "paper_id string, lang string, ingested_at string"
    for part, year in ((docs.filter("doc_id % 3 = 0"), 2024), (docs, 2019)):
        part.select("paper_id", "lang", F.lit(f"{year}-05-01 00:00:00").alias("ingested_at")).write.mode("append").json(landing)
        stream = inc.usable_records(inc.stream_json(v.spark, landing, schema))
        inc.ingest(stream, checkpoint, inc.store_new(out)).awaitTermination()
    return v.spark.read.parquet(out).select("paper_id", F.year("ingested_at").alias("year"), "lang")


def _refreshed(v, stem: bool):
    table, index = v.scratch("papers"), v.scratch("index")
    v.texts.withColumn("ingest_year_month", F.coalesce(F.date_format("submitted_date", "yyyy"), F.lit("unknown"))).write.option(
        "compression", "zstd"
    ).parquet(table)

    def papers():
        return v.spark.read.parquet(table)

    stream = v.spark.readStream.schema(papers().schema).parquet(table)
    inc.ingest(stream, v.scratch("checkpoint"), inc.refresh_index(papers, index, stem)).awaitTermination()
    return shown(search.search_index(v.spark, index, v.queries, stem=stem))


@query("texts", "queries", sql=f"{bm25_sql(TWO_FIELDS, stem=True)} {SHOWN_SQL}")
def stream_index_refresh(v):
    """Months touched by arriving papers are indexed again, then every benchmark passage is searched."""
    return _refreshed(v, True)


@query("texts", "queries", sql=f"{bm25_sql(TWO_FIELDS)} {SHOWN_SQL}")
def stream_index_refresh_plain(v):
    """The same with unstemmed words."""
    return _refreshed(v, False)
