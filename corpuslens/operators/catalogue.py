"""Listings, lookups and reports over papers and their scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import identifiers as ids
from corpuslens.operators.influence import guarded_range

SORTABLE = ("citation_count", "submitted_date", "title", "paper_id")
SORT_MODES = {"influence": "pagerank_score", "citations": "citation_count", "recency": "submitted_date"}


def _bounded(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must lie in {low}..{high}")
    return value


def with_scores(papers: DataFrame, scores: DataFrame, how: str = "left") -> DataFrame:
    return papers.join(scores.select("paper_id", "pagerank_score"), "paper_id", how)


def score_or_floor(papers: DataFrame, scores: DataFrame) -> DataFrame:
    """Papers with their score, or the floor where none is known."""
    return with_scores(papers, scores).withColumn(
        "pagerank_score", F.coalesce("pagerank_score", F.lit(fixed.SCORE_FLOOR))
    )


def _where(papers: DataFrame, **equal) -> DataFrame:
    for name, value in equal.items():
        if value:
            papers = papers.filter(F.col(name) == value)
    return papers


def list_papers(
    papers: DataFrame, scores: DataFrame, category: str | None = None, source: str | None = None,
    sort_by: str = "citation_count", order: str = "DESC", limit: int = 20, offset: int = 0,
) -> DataFrame:
    """One page of papers. Unknown sort keys and orders fall back to the defaults.

    The page is cut before the scores are joined, so the join sees one page only.
    """
    _bounded("limit", limit, 1, 100)
    _bounded("offset", offset, 0, 2**31 - 1)
    key = F.col(sort_by if sort_by in SORTABLE else "citation_count")
    falling = order.upper() != "ASC"
    ordering = (key.desc() if falling else key.asc(), F.col("paper_id"))
    page = _where(papers, primary_category=category, source=source).orderBy(*ordering)
    return with_scores(page.offset(offset).limit(limit), scores).orderBy(*ordering)


def top_influential(
    papers: DataFrame, scores: DataFrame, category: str | None = None, k: int = 10
) -> DataFrame:
    _bounded("k", k, 1, 50)
    rows = with_scores(_where(papers, primary_category=category), scores, "inner")
    return rows.filter(F.col("pagerank_score").isNotNull()).orderBy(
        F.col("pagerank_score").desc(), "paper_id"
    ).limit(k)


def top_by_mode(papers: DataFrame, scores: DataFrame, mode: str, k: int = 10) -> DataFrame:
    """Influential papers in one of the modes influence, citations, recency."""
    return with_scores(papers, scores, "inner").orderBy(
        F.col(SORT_MODES[mode]).desc(), "paper_id"
    ).limit(k)


def page_after(
    df: DataFrame, last_id: str | None = None, size: int = 1000, key: str = "paper_id"
) -> DataFrame:
    """The page that follows `last_id` in key order; the filter reaches the scan."""
    rows = df if last_id is None else df.filter(F.col(key) > last_id)
    return rows.orderBy(key).limit(size)


def substring_search(
    papers: DataFrame, q: str, columns: Sequence[str] = ("title", "abstract"), ignore_case: bool = False,
    category: str | None = None,
) -> DataFrame:
    """Papers that hold `q` literally in any column; % and _ are ordinary characters."""

    def holds(name: str) -> Column:
        if ignore_case:
            return F.contains(F.lower(name), F.lower(F.lit(q)))
        return F.contains(F.col(name), F.lit(q))

    hit = holds(columns[0])
    for name in columns[1:]:
        hit = hit | holds(name)
    return _where(papers, primary_category=category).filter(hit)


def landscape(
    papers: DataFrame, scores: DataFrame, category: str | None = None, start: str | None = None,
    end: str | None = None, min_score: float | None = None, limit: int | None = 5000,
) -> DataFrame:
    """Placed papers of a category and date range above a score, in key order."""
    rows = _where(papers, primary_category=category).filter(
        F.col("umap_x").isNotNull() & F.col("umap_y").isNotNull()
    )
    if start:
        rows = rows.filter(F.col("submitted_date") >= F.lit(start).cast("date"))
    if end:
        rows = rows.filter(F.col("submitted_date") <= F.lit(end).cast("date"))
    rows = with_scores(rows, scores)
    if min_score is not None:
        rows = rows.filter(F.coalesce("pagerank_score", F.lit(0.0)) >= min_score)
    if limit is not None:
        rows = rows.orderBy("paper_id").limit(_bounded("limit", limit, 1, 20000))
    return rows


def viewport(
    points: DataFrame, width: tuple[float, float] = (20.0, 680.0), height: tuple[float, float] = (20.0, 430.0)
) -> DataFrame:
    """Scale coordinates onto a drawing area."""
    low_high = points.agg(F.struct(
        F.min("umap_x").alias("x0"), F.max("umap_x").alias("x1"),
        F.min("umap_y").alias("y0"), F.max("umap_y").alias("y1"),
    ).alias("b")).scalar()

    def scaled(name: str, low: Column, high: Column, to: tuple[float, float]) -> Column:
        return (F.col(name) - low) / guarded_range(low, high) * (to[1] - to[0]) + to[0]

    placed = points.filter(F.col("umap_x").isNotNull() & F.col("umap_y").isNotNull())
    return placed.withColumns({
        "view_x": scaled("umap_x", low_high["x0"], low_high["x1"], width),
        "view_y": scaled("umap_y", low_high["y0"], low_high["y1"], height),
    })


def legend(points: DataFrame, k: int = 8) -> DataFrame:
    """The first topics met when points are read in key order."""
    kept = points.filter(F.col("topic_cluster_id").isNotNull() & (F.col("topic_cluster_id") != -1))
    name = F.coalesce("topic_cluster", F.concat(F.lit("Cluster "), F.col("topic_cluster_id").cast("string")))
    return kept.groupBy("topic_cluster_id").agg(
        F.min("paper_id").alias("first_paper"), F.min_by(name, F.col("paper_id")).alias("topic_name")
    ).orderBy("first_paper").limit(k)


def restrict_to(points: DataFrame, hits: DataFrame) -> DataFrame:
    """Points that are among the search hits."""
    return points.join(hits.select("paper_id"), "paper_id", "left_semi")


def unmatched(requested: DataFrame, found: DataFrame) -> DataFrame:
    """Requested ids without any match."""
    return requested.select("paper_id").join(found.select("paper_id"), "paper_id", "left_anti")


def lookup(df: DataFrame, requested: DataFrame, key: str = "paper_id") -> DataFrame:
    """Rows of the requested ids."""
    return df.join(requested.select(F.col("paper_id").alias(key)).distinct(), key, "left_semi")


def fetch_fulltext(requested: DataFrame, fulltext: DataFrame) -> DataFrame:
    """Body of each requested paper: by its own key, else by the preprint id.

    Both keys go into one tall frame, so one join serves either key.
    """
    bodies = fulltext.filter(ids.valid_key(F.col("full_text")))
    keyed = bodies.select(F.col("paper_id"), F.lit(0).alias("form"), "full_text").unionAll(
        bodies.filter(F.col("arxiv_id").isNotNull()).select("arxiv_id", F.lit(1), "full_text")
    )
    wanted = keyed.join(requested.select("paper_id").distinct(), "paper_id", "left_semi")
    best = wanted.groupBy("paper_id").agg(F.min(F.struct("form", "full_text"))["full_text"].alias("full_text"))
    return requested.join(best, "paper_id", "left").withColumn("has_fulltext", F.col("full_text").isNotNull())


def fulltext_overview(papers: DataFrame, fulltext: DataFrame) -> DataFrame:
    """Papers with a body: its length and number of sections."""
    sizes = fulltext.select(
        "paper_id", F.length("full_text").alias("text_length"),
        F.size(F.coalesce("sections", F.array())).alias("section_count"),
    )
    return papers.select("paper_id", "title").join(sizes, "paper_id", "inner")


def with_entities(papers: DataFrame, column: str = "methods") -> DataFrame:
    return papers.filter(F.size(F.coalesce(column, F.array())) > 0)


def corpus_stats(
    papers: DataFrame, edges: DataFrame, scores: DataFrame, trend_table: DataFrame
) -> DataFrame:
    """One row of corpus totals; each table is aggregated once and read as a constant."""
    one = papers.sparkSession.range(1)

    def totals(df: DataFrame, **agg: Column) -> Column:
        return df.agg(F.struct(*[c.alias(n) for n, c in agg.items()]).alias("t")).scalar()

    count = F.count(F.lit(1))
    p = totals(
        papers, n=count, cats=F.countDistinct("primary_category"), lo=F.min("submitted_date"),
        hi=F.max("submitted_date"), ner=F.count_if(F.size(F.coalesce("methods", F.array())) > 0),
    )
    e = totals(edges, n=count)
    s = totals(scores, n=count, hi=F.max("pagerank_score"), mean=F.avg("pagerank_score"))
    t = totals(
        trend_table.filter(F.col("topic_cluster").isNotNull()),
        months=F.countDistinct("year_month"), topics=F.countDistinct("topic_cluster"),
    )
    return one.select(
        p["n"].alias("total_papers"), p["cats"].alias("total_categories"),
        p["lo"].alias("earliest_paper"), p["hi"].alias("latest_paper"), p["ner"].alias("ner_papers"),
        e["n"].alias("total_edges"), s["n"].alias("scored_papers"),
        F.round(s["hi"], 2).alias("max_pagerank"), F.round(s["mean"], 2).alias("avg_pagerank"),
        t["months"].alias("months_covered"), t["topics"].alias("topic_count"),
    )


def topic_clusters(papers: DataFrame, k: int | None = 100) -> DataFrame:
    """Size and centre of each topic, the largest first; all of them without `k`."""
    kept = papers.filter(F.col("topic_cluster_id").isNotNull() & (F.col("topic_cluster_id") != -1))
    found = kept.groupBy("topic_cluster_id", "topic_cluster").agg(
        F.count(F.lit(1)).alias("paper_count"),
        F.avg("umap_x").alias("centroid_x"), F.avg("umap_y").alias("centroid_y"),
    ).orderBy(F.col("paper_count").desc(), "topic_cluster_id")
    return found if k is None else found.limit(k)


def trending_topics(papers: DataFrame, k: int = 20) -> DataFrame:
    named = papers.filter(ids.valid_key(F.col("topic_cluster")))
    return named.groupBy(F.col("topic_cluster").alias("entity")).agg(
        F.count(F.lit(1)).alias("paper_count")
    ).orderBy(F.col("paper_count").desc(), "entity").limit(k)


def label_coverage(papers: DataFrame, labels: DataFrame) -> DataFrame:
    """Share of each source's papers that have a label."""
    joined = papers.join(labels.select("paper_id").distinct().withColumn("has", F.lit(1)), "paper_id", "left")
    return joined.groupBy("source").agg(
        F.count(F.lit(1)).alias("papers"), F.count("has").alias("labelled"),
        F.round(F.count("has") / F.count(F.lit(1)), 4).alias("coverage"),
    )
