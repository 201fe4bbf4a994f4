"""Monthly trends, their signals and the series drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import identifiers as ids
from corpuslens.operators.influence import in_degree

CATEGORY, TOPIC = "category", "topic"
TREND_COLUMNS = (
    "grain", "primary_category", "topic_cluster", "topic_cluster_id", "year_month", "paper_count",
    "avg_citation_count", "avg_pagerank",
)


def dated_papers(papers: DataFrame, scores: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Papers with month, score and citations; edges count before the join, one row per target."""
    rows = (
        papers.select(
            "paper_id", "primary_category", "topic_cluster", "topic_cluster_id",
            F.col("citation_count").cast("double").alias("citation_count"),
            ids.month_of(F.col("submitted_date")).alias("year_month"),
        )
        .filter(ids.valid_key(F.col("year_month")))
        .join(scores.select("paper_id", "pagerank_score"), "paper_id", "left")
    )
    if edges is None:
        return rows
    cited = in_degree(edges).withColumnRenamed("cited_id", "paper_id")
    return rows.join(cited, "paper_id", "left").withColumn(
        "citation_count", F.coalesce(F.col("edge_citation_count").cast("double"), "citation_count")
    ).drop("edge_citation_count")


def trends(dated: DataFrame) -> DataFrame:
    """Category and topic grain in one pass.

    Sums are first taken at the finer grain; the two grains are grouping sets of that small result.
    """
    fine = ["primary_category", "topic_cluster", "topic_cluster_id", "year_month"]
    cells = dated.groupBy(*fine).agg(
        F.count(F.lit(1)).alias("papers"),
        F.sum("citation_count").alias("cites"), F.count("citation_count").alias("n_cites"),
        F.sum("pagerank_score").alias("score"), F.count("pagerank_score").alias("n_score"),
    )
    both = cells.groupingSets([["primary_category", "year_month"], fine], *fine).agg(
        F.when(F.grouping("topic_cluster") == 1, CATEGORY).otherwise(TOPIC).alias("grain"),
        F.sum("papers").alias("paper_count"),
        F.try_divide(F.sum("cites"), F.sum("n_cites")).alias("avg_citation_count"),
        F.try_divide(F.sum("score"), F.sum("n_score")).alias("avg_pagerank"),
    )
    return both.filter((F.col("grain") == CATEGORY) | F.col("topic_cluster").isNotNull()).select(*TREND_COLUMNS)


def filter_trends(
    table: DataFrame, grain: str | None = None, category: str | None = None, topic: str | None = None,
    start: str | None = None, end: str | None = None,
) -> DataFrame:
    """Trend rows for optional category, topic and closed month range, by month."""
    rows = table
    for name, value in (("grain", grain), ("primary_category", category), ("topic_cluster", topic)):
        if value:
            rows = rows.filter(F.col(name) == value)
    if start:
        rows = rows.filter(F.col("year_month") >= start)
    if end:
        rows = rows.filter(F.col("year_month") <= end)
    return rows.orderBy("year_month", "grain", "primary_category", "topic_cluster")


def trend_summary(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count(F.lit(1)).alias("trend_rows"),
        F.countDistinct("primary_category").alias("categories"),
        F.countDistinct("topic_cluster").alias("topics"),
        F.countDistinct("year_month").alias("months"),
        F.sum(F.when(F.col("grain") == CATEGORY, F.col("paper_count"))).alias("papers"),
        F.min("year_month").alias("first_month"), F.max("year_month").alias("last_month"),
    )


def topic_rows(table: DataFrame) -> DataFrame:
    return table.filter((F.col("grain") == TOPIC) & ids.valid_key(F.col("topic_cluster")))


def topic_month_series(table: DataFrame) -> DataFrame:
    return topic_rows(table).groupBy("topic_cluster", "year_month").agg(
        F.sum("paper_count").alias("paper_count")
    )


def dominant_topics(table: DataFrame, k: int = 6) -> DataFrame:
    sums = topic_rows(table).groupBy("topic_cluster").agg(F.sum("paper_count").alias("paper_count"))
    return sums.orderBy(F.col("paper_count").desc(), "topic_cluster").limit(k)


def trend_signals(series: DataFrame, window: int = 3, k: int = 4) -> DataFrame:
    """Emerging, stable and declining topics from the last months against those just before.

    A topic with n months compares min(window, n/2) months; with one month it has no signal. Windows
    run on one row per topic and month, so their size is the number of months.
    """
    per_topic = Window.partitionBy("topic_cluster")
    back = F.row_number().over(per_topic.orderBy(F.col("year_month").desc()))
    n = F.count(F.lit(1)).over(per_topic)
    rows = series.select("topic_cluster", "paper_count", back.alias("back"), n.alias("n")).filter("n >= 2")
    width = F.least(F.lit(window), F.greatest(F.lit(1), F.floor(F.col("n") / 2)))
    averages = rows.withColumn("w", width).groupBy("topic_cluster").agg(
        F.avg(F.when(F.col("back") <= F.col("w"), F.col("paper_count"))).alias("recent"),
        F.avg(
            F.when(F.col("back").between(F.col("w") + 1, 2 * F.col("w")), F.col("paper_count"))
        ).alias("prior"),
    )
    growth = (F.col("recent") - F.col("prior")) / F.greatest("prior", F.lit(1.0))
    graded = averages.withColumn("growth", growth).select(
        "topic_cluster",
        F.when(F.col("growth") >= fixed.EMERGING_GROWTH, "emerging")
        .when(F.col("growth") <= fixed.DECLINING_GROWTH, "declining").otherwise("stable").alias("signal"),
        F.round("growth", 3).alias("growth_rate"),
        F.round(F.col("growth") * 100, 1).alias("growth_pct"),
        F.round("recent", 2).alias("recent_avg_papers"),
    )
    strength = (
        F.when(F.col("signal") == "emerging", -F.col("growth_rate"))
        .when(F.col("signal") == "declining", F.col("growth_rate"))
        .otherwise(-F.col("recent_avg_papers"))
    )
    place = F.row_number().over(Window.partitionBy("signal").orderBy(strength, "topic_cluster"))
    return graded.withColumn("place", place).filter(F.col("place") <= k)


def monthly_volume(table: DataFrame, months: int = 12) -> DataFrame:
    """Papers of the last months, oldest first, at category grain so that none counts twice."""
    sums = table.filter((F.col("grain") == CATEGORY) & ids.valid_key(F.col("year_month"))).groupBy(
        "year_month"
    ).agg(F.sum("paper_count").alias("papers"))
    return sums.orderBy(F.col("year_month").desc()).limit(months).orderBy("year_month")


def explorer_series(table: DataFrame) -> DataFrame:
    return table.filter(F.col("grain") == CATEGORY).groupBy("year_month").agg(
        F.sum("paper_count").alias("papers")
    ).orderBy("year_month")


def explorer_citations(table: DataFrame, k: int = 5) -> DataFrame:
    """Mean of the monthly citation averages of each category, the highest first."""
    means = table.filter(F.col("grain") == CATEGORY).groupBy("primary_category").agg(
        F.round(F.avg("avg_citation_count"), 2).alias("mean_citations")
    )
    return means.filter(F.col("mean_citations").isNotNull()).orderBy(
        F.col("mean_citations").desc(), "primary_category"
    ).limit(k)


def series_matrix(
    table: DataFrame, values: Sequence[str], key: str = "primary_category", grain: str = CATEGORY
) -> DataFrame:
    """Month by series, zero where a series has no papers in a month."""
    return (
        table.filter(F.col("grain") == grain).groupBy("year_month").pivot(key, list(values))
        .sum("paper_count").na.fill(0)
    )


def share_of_top(counts: DataFrame, count: str = "paper_count") -> DataFrame:
    """Each count as a rounded percentage of the greatest."""
    top = counts.agg(F.max(count).alias("top")).scalar()
    return counts.withColumn("pct", F.round(100.0 * F.col(count) / top).cast("int"))


def ingestion_log(papers: DataFrame, page: int = 0, size: int = 25) -> DataFrame:
    """One page of papers, newest first, grouped by month; the page bounds every group."""
    day = F.col("submitted_date")
    rows = papers.orderBy(day.desc(), "paper_id").offset(page * size).limit(size)
    month = F.coalesce(ids.month_of(day), F.lit("Unknown"))
    return rows.groupBy(month.alias("year_month")).agg(
        F.count(F.lit(1)).alias("papers"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(-F.unix_date(day), F.col("paper_id")))),
                lambda r: r["paper_id"],
            ),
            " ",
        ).alias("paper_ids"),
    ).orderBy(F.col("year_month").desc())


def months_logged(papers: DataFrame) -> DataFrame:
    """Papers of every month, newest first, with a bucket for undated ones."""
    month = F.coalesce(ids.month_of(F.col("submitted_date")), F.lit("Unknown"))
    return papers.groupBy(month.alias("year_month")).agg(
        F.count(F.lit(1)).alias("papers")
    ).orderBy(F.col("year_month").desc())
