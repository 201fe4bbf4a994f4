"""Citation neighbourhoods. Requests are a frame, so one plan answers one id or all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import identifiers as ids


def _first_per_request(hits: DataFrame, limit: int | None) -> DataFrame:
    """Each hit once, and the first `limit` of each request. Equal hits share a rank, so they are cut along with the others:
    Spark keeps at most that many per task before the shuffle, and a request with very many edges stays cheap."""
    if limit is None:
        return hits.distinct()
    place = F.dense_rank().over(Window.partitionBy("request_id").orderBy("paper_id"))
    return hits.withColumn("place", place).filter(F.col("place") <= limit).drop("place").distinct()


def _described(df: DataFrame, papers: DataFrame, scores: DataFrame) -> DataFrame:
    return (
        df.join(papers.select("paper_id", "title"), "paper_id", "left")
        .join(scores.select("paper_id", "pagerank_score"), "paper_id", "left")
    )


def _citing(requested: DataFrame, edges: DataFrame, papers: DataFrame, limit: int | None) -> DataFrame:
    own = requested.select(F.col("paper_id").alias("request_id"))
    known = own.join(
        papers.select(F.col("paper_id").alias("request_id"), "s2_paper_id"), "request_id"
    ).filter(ids.valid_key(F.col("s2_paper_id")))
    forms = own.select("request_id", F.col("request_id").alias("cited_id")).unionAll(
        known.select("request_id", F.col("s2_paper_id").alias("cited_id"))
    ).distinct()
    hits = edges.join(forms, "cited_id").select("request_id", F.col("citing_id").alias("paper_id"))
    return _first_per_request(hits, limit)


def _cited(requested: DataFrame, edges: DataFrame, papers: DataFrame, limit: int | None) -> DataFrame:
    out = edges.join(
        requested.select(F.col("paper_id").alias("citing_id")).distinct(), "citing_id", "left_semi"
    ).select(F.col("citing_id").alias("request_id"), "cited_id")
    names = papers.select(F.col("paper_id").alias("cited_id"), "paper_id").unionAll(
        papers.filter(ids.valid_key(F.col("s2_paper_id"))).select(F.col("s2_paper_id").alias("cited_id"), "paper_id")
    )
    return _first_per_request(out.join(names, "cited_id").select("request_id", "paper_id"), limit)


def cited_by(
    requested: DataFrame, edges: DataFrame, papers: DataFrame, scores: DataFrame, limit: int | None = 50
) -> DataFrame:
    """Papers that cite a requested one, under its key or its alternate id; once each, as in `references`."""
    return _described(_citing(requested, edges, papers, limit), papers, scores)


def references(
    requested: DataFrame, edges: DataFrame, papers: DataFrame, scores: DataFrame, limit: int | None = 50
) -> DataFrame:
    """Corpus papers that a requested one cites, found by key or by alternate id.

    Papers are listed under both names, so the edges are read once and meet them in one equi-join; a join with OR would
    compare every pair.
    """
    return _described(_cited(requested, edges, papers, limit), papers, scores)


def neighbourhood(
    requested: DataFrame, edges: DataFrame, papers: DataFrame, scores: DataFrame,
    direction: str = "both", limit: int | None = 50,
) -> DataFrame:
    """Neighbours in either direction; titles and scores are joined once to all of them."""
    if limit is not None and not 1 <= limit <= 200:
        raise ValueError("limit must lie in 1..200")
    found = {"cited_by": _citing, "references": _cited}
    wanted = list(found) if direction == "both" else [direction]
    if wanted[0] not in found:
        raise ValueError("direction must be cited_by, references or both")
    parts = [
        found[name](requested, edges, papers, limit).withColumn("direction", F.lit(name)) for name in wanted
    ]
    hits = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _described(hits, papers, scores).select("request_id", "direction", "paper_id", "title", "pagerank_score")


def paper_detail(requested: DataFrame, papers: DataFrame, scores: DataFrame, edges: DataFrame) -> DataFrame:
    """All fields of the requested papers, with score and degrees. The neighbours themselves are rows
    of `paper_links`: a paper cited by a large part of the corpus must not become one array."""
    asked = requested.select("paper_id").distinct()

    def degree(end: str, name: str) -> DataFrame:
        """Counted for the requested papers only."""
        at = edges.select(F.col(end).alias("paper_id")).join(asked, "paper_id", "left_semi")
        return at.groupBy("paper_id").agg(F.count(F.lit(1)).alias(name))

    cited, citing = degree("cited_id", "cited_by_count"), degree("citing_id", "references_count")
    return (
        papers.join(asked, "paper_id", "left_semi")
        .join(scores.select("paper_id", "pagerank_score"), "paper_id", "left")
        .join(cited, "paper_id", "left").join(citing, "paper_id", "left")
        .na.fill(0, ["cited_by_count", "references_count"])
    )


def paper_links(requested: DataFrame, edges: DataFrame) -> DataFrame:
    """Every neighbour of the requested papers, one per row."""
    asked = requested.select("paper_id").distinct()
    both = edges.select(
        F.col("cited_id").alias("paper_id"), F.lit("cited_by").alias("direction"), F.col("citing_id").alias("other_id")
    ).unionAll(edges.select("citing_id", F.lit("references"), "cited_id"))
    return both.join(asked, "paper_id", "left_semi")


def incident_edges(edges: DataFrame, paper_id: str | None = None, limit: int | None = 50) -> DataFrame:
    """Edges at a paper, or of the whole graph, in key order; all of them without a limit."""
    if limit is not None and not 1 <= limit <= 200:
        raise ValueError("limit must lie in 1..200")
    rows = edges
    if paper_id is not None:
        rows = rows.filter((F.col("citing_id") == paper_id) | (F.col("cited_id") == paper_id))
    ordered = rows.select("citing_id", "cited_id").orderBy("citing_id", "cited_id")
    return ordered if limit is None else ordered.limit(limit)
