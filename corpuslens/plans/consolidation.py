"""The batch run: landing files to the five curated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslens.operators import consolidate, influence
from corpuslens.operators import trends as tr
from corpuslens.session import cut_lineage, discard, working_path
from corpuslens.sources import readers, writers


def build_papers(a: DataFrame, b: DataFrame, c: DataFrame) -> DataFrame:
    return consolidate.curate(consolidate.merge_sources(a, b, c))


def build_trends(papers: DataFrame, scores: DataFrame, edges: DataFrame | None) -> DataFrame:
    return tr.trends(tr.dated_papers(papers, scores, edges))


def run(spark: SparkSession, landing: str, database: str) -> None:
    """Merge the sources, add topics and entities where they landed, then scores and trends.

    Each table is written once and read back by the step after it, so a lost executor costs one step. The corpus
    folder, which feeds three tables, is parsed once and then read by columns.
    """
    parsed = working_path(spark, "corpus")
    raw_b = cut_lineage(readers.read_raw_b(spark, f"{landing}/s2orc"), parsed)
    papers = build_papers(
        readers.read_source_a(spark, f"{landing}/arxiv"),
        readers.unify_b(raw_b),
        readers.read_source_c(spark, f"{landing}/openalex"),
    )
    for name, reader, columns in (
        ("ner", readers.read_entities, ["methods", "datasets", "tasks"]),
        (
            "bertopic", readers.read_topic_assignments,
            ["topic_cluster_id", "topic_cluster", "umap_x", "umap_y"],
        ),
    ):
        if writers.path_exists(spark, f"{landing}/{name}"):
            papers = writers.replace_columns(papers, reader(spark, f"{landing}/{name}"), "paper_id", columns)
    writers.write_papers(papers, f"{database}.papers")
    writers.write_flat(consolidate.dedup_edges(readers.unify_edges(raw_b)), f"{database}.citation_edges")
    writers.write_flat(
        consolidate.longest_fulltext(readers.unify_fulltext(raw_b)), f"{database}.paper_fulltext"
    )
    discard(spark, parsed)
    stored = spark.table(f"{database}.papers")
    writers.write_flat(influence.influence_scores(stored), f"{database}.pagerank_scores")
    writers.write_flat(
        build_trends(
            stored, spark.table(f"{database}.pagerank_scores"), spark.table(f"{database}.citation_edges")
        ),
        f"{database}.trends",
    )
