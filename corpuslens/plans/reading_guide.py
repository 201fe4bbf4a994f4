"""The reading guide: from query texts to categorised, annotated papers in one plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.operators import catalogue, search
from corpuslens.operators import selection as sel
from corpuslens.session import cut_lineage

DETAILS = (
    "paper_id", "title", "abstract", "topic_cluster", "topic_cluster_id", "umap_x", "umap_y",
    "citation_count", "submitted_date",
)


def select_papers(
    papers: DataFrame, scores: DataFrame, queries: DataFrame, as_of: Column, n: int = 20,
    max_candidates: int = 200, weights: Mapping[str, float] | None = None, stem: bool = True,
) -> DataFrame:
    """Ranked papers of each query with their signals and the reason for each."""
    hits = search.candidates(papers, queries, max_candidates, stem).select(
        "query_id", "paper_id", F.col("score").alias("es_score")
    )
    details = hits.join(papers.select(*DETAILS), "paper_id")
    scored = sel.score_signals(catalogue.score_or_floor(details, scores), as_of)
    chosen = sel.select_diverse(scored, n, weights)
    return chosen.withColumn("selection_reason", sel.selection_reason())


def reading_guide(
    papers: DataFrame, scores: DataFrame, fulltext: DataFrame, queries: DataFrame, as_of: Column,
    n: int = 20, max_candidates: int = 200, weights: Mapping[str, float] | None = None,
    cap: int = 10, stem: bool = True,
    classify: Callable[[DataFrame], DataFrame] = sel.classify_with_cues,
) -> DataFrame:
    """Categorised papers with four lists of telling sentences.

    The selection is small (queries times `n`) and feeds both the text analysis and the final join,
    so it is written to the shared folder once.
    """
    chosen = cut_lineage(select_papers(papers, scores, queries, as_of, n, max_candidates, weights, stem))
    wanted = chosen.select("paper_id", "abstract").distinct()
    bodies = catalogue.fetch_fulltext(wanted.select("paper_id"), fulltext)
    texts = wanted.join(bodies, "paper_id")
    notes = sel.annotations(sel.top_sentences(classify(sel.paper_sentences(texts))))
    assigned = sel.cap_per_category(sel.assign_categories(chosen), cap)
    merged = sel.merge_annotations(assigned, notes).join(
        bodies.select("paper_id", "has_fulltext"), "paper_id", "left"
    )
    return merged.withColumn("category_reason", sel.category_reason())
