"""Evidence for ideas and recurring limitation themes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import text as tx
from corpuslens.operators.catalogue import substring_search, with_scores


def idea_evidence(
    papers: DataFrame, scores: DataFrame, q: str, category: str | None = None, limit: int | None = 20,
    support: Sequence[str] = fixed.SUPPORT_CUES, caution: Sequence[str] = fixed.CAUTION_CUES,
    limitation: Sequence[str] = fixed.LIMITATION_CUES,
) -> DataFrame:
    """The most influential papers that mention `q`, whether each supports or warns, and its first
    limitation sentence."""
    if len(q) < 3:
        raise ValueError("the idea needs at least three characters")
    rows = with_scores(substring_search(papers, q, ignore_case=True, category=category), scores)
    if limit is not None:
        rows = rows.orderBy(
            F.coalesce("pagerank_score", F.lit(0.0)).desc(), F.col("submitted_date").desc(), "paper_id"
        ).limit(limit)
    low = F.lower(F.coalesce("abstract", F.lit("")))
    topic = F.coalesce(F.nullif(F.trim("topic_cluster"), F.lit("")), F.lit("Unknown"))
    return rows.select(
        "paper_id", "title", "primary_category", "submitted_date", topic.alias("topic_cluster"),
        "pagerank_score",
        tx.contains_any(low, support).alias("supports"),
        tx.contains_any(low, caution).alias("cautions"),
        F.get(tx.cue_sentences(F.col("abstract"), limitation, 1), F.lit(0)).alias("limitation_snippet"),
    )


def idea_summary(evidence: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    good = F.count_if("supports")
    return evidence.agg(
        n.alias("evidence_papers"), good.alias("supporting_signals"),
        F.count_if("cautions").alias("cautionary_signals"),
        F.round(good / F.greatest(n, F.lit(1)), 3).alias("support_ratio"),
    )


def idea_topics(evidence: DataFrame, k: int = 6) -> DataFrame:
    return evidence.groupBy("topic_cluster").agg(F.count(F.lit(1)).alias("paper_count")).orderBy(
        F.col("paper_count").desc(), "topic_cluster"
    ).limit(k)


def newest_abstracts(
    papers: DataFrame, n: int | None = 250, category: str | None = None, topic: str | None = None
) -> DataFrame:
    """Papers with a non-blank abstract, the newest `n` of them or all."""
    rows = papers.filter(F.length(F.trim("abstract")) > 0)
    if category:
        rows = rows.filter(F.col("primary_category") == category)
    if topic:
        rows = rows.filter(F.col("topic_cluster") == topic)
    return rows if n is None else rows.orderBy(F.col("submitted_date").desc(), "paper_id").limit(n)


def _matched(abstracts: DataFrame, themes: Mapping[str, Sequence[str]], cues: Sequence[str]) -> DataFrame:
    low = F.lower("abstract")
    hits = F.array_compact(F.array(*[
        F.when(tx.contains_any(low, phrases), F.lit(name)) for name, phrases in themes.items()
    ]))
    return abstracts.withColumn("themes", hits).withColumn(
        "snippet", F.get(tx.cue_sentences(F.col("abstract"), cues, 1), F.lit(0))
    )


def limitation_themes(
    abstracts: DataFrame, themes: Mapping[str, Sequence[str]] = fixed.THEMES,
) -> DataFrame:
    """Papers per theme, the most frequent first; a paper counts in each theme it touches."""
    hits = tx.unfold(_matched(abstracts, themes, fixed.LIMITATION_CUES), F.col("themes"), "theme")
    return hits.groupBy("theme").agg(F.count(F.lit(1)).alias("papers")).orderBy(
        F.col("papers").desc(), "theme"
    )


def theme_examples(
    abstracts: DataFrame, themes: Mapping[str, Sequence[str]] = fixed.THEMES,
    cues: Sequence[str] = fixed.LIMITATION_CUES, k: int = 3,
) -> DataFrame:
    """The newest papers of each theme with a limitation sentence."""
    hits = tx.unfold(
        _matched(abstracts, themes, cues), F.col("themes"), "theme",
        "paper_id", "title", "topic_cluster", "submitted_date", "snippet",
    )
    order = Window.partitionBy("theme").orderBy(F.col("submitted_date").desc(), F.col("paper_id"))
    return hits.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def theme_coverage(abstracts: DataFrame, themes: Mapping[str, Sequence[str]] = fixed.THEMES) -> DataFrame:
    """How many of the scanned papers touch any theme."""
    every = [p for phrases in themes.values() for p in phrases]
    hit = F.count_if(tx.contains_any(F.lower("abstract"), every))
    n = F.count(F.lit(1))
    return abstracts.agg(
        n.alias("scanned_papers"), hit.alias("papers_with_limitations"),
        F.round(hit / F.greatest(n, F.lit(1)), 3).alias("coverage_ratio"),
    )
