"""Influence of papers: a score from citation counts, and iterative PageRank on the edges."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import identifiers as ids
from corpuslens.session import bucketed, cut_lineage, discard, working_path


def guarded_range(low: Column, high: Column) -> Column:
    """Width of a range, or 1 where it is empty."""
    return F.when(high > low, high - low).otherwise(F.lit(1.0))


def influence_scores(papers: DataFrame) -> DataFrame:
    """Logarithm of the citation count, scaled by its extremes onto [0.15, 1].

    The two extremes come from one aggregate of one row that the second scan reads as a constant.
    """
    logs = papers.filter(ids.valid_key(F.col("paper_id"))).select(
        "paper_id", F.log1p(F.coalesce(F.col("citation_count").cast("double"), F.lit(0.0))).alias("log")
    )
    bounds = logs.agg(F.struct(F.min("log").alias("lo"), F.max("log").alias("hi")).alias("b")).scalar()
    share = (F.col("log") - bounds["lo"]) / guarded_range(bounds["lo"], bounds["hi"])
    return logs.select(
        "paper_id", (F.lit(fixed.SCORE_FLOOR) + F.lit(fixed.SCORE_SPAN) * share).alias("pagerank_score")
    )


def score_summary(scores: DataFrame) -> DataFrame:
    score = F.col("pagerank_score")
    above = F.count_if(score > fixed.SCORE_FLOOR)
    total = F.count(F.lit(1))
    return scores.agg(
        F.avg(score).alias("avg_score"), F.max(score).alias("max_score"), F.min(score).alias("min_score"),
        F.stddev_samp(score).alias("stddev_score"), total.alias("total"), above.alias("above_floor"),
        F.try_divide(100.0 * above, total).alias("above_floor_pct"),
    )


def in_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("cited_id").agg(F.count(F.lit(1)).alias("edge_citation_count"))


def resolvability(edges: DataFrame, id_pattern: str = fixed.PREPRINT_ID) -> DataFrame:
    """How many edges have corpus-shaped ids at both ends."""
    both = F.count_if(F.col("citing_id").rlike(id_pattern) & F.col("cited_id").rlike(id_pattern))
    total = F.count(F.lit(1))
    return edges.agg(
        total.alias("edges"), both.alias("resolvable"), F.try_divide(both, total).alias("share")
    )


def resolve_edges(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """Edges between papers of the corpus. A target given by its alternate id becomes its paper.

    An id that is a paper's own key wins over the same string as an alternate id.
    """
    own = papers.select(F.col("paper_id").alias("id"), F.col("paper_id").alias("node"), F.lit(0).alias("form"))
    alternate = papers.filter(ids.valid_key(F.col("s2_paper_id"))).select(
        F.col("s2_paper_id").alias("id"), F.col("paper_id").alias("node"), F.lit(1).alias("form")
    )
    names = own.unionAll(alternate).groupBy("id").agg(F.min_by("node", F.struct("form", "node")).alias("node"))
    ends = edges.join(names.select(F.col("id").alias("citing_id"), F.col("node").alias("src")), "citing_id")
    ends = ends.join(names.select(F.col("id").alias("cited_id"), F.col("node").alias("dst")), "cited_id")
    return ends.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()


def pagerank(
    nodes: DataFrame, links: DataFrame, iterations: int = 10, reset: float = fixed.SCORE_FLOOR,
    links_per_bucket: int = 1_000_000,
) -> DataFrame:
    """PageRank of `nodes(id)` over `links(src, dst)`, with mean rank 1.

    Nodes get numbers, and each node's row holds the numbers that it links to. The table is written once, in buckets, so a round
    reads it where it lies and shuffles only what targets receive, which combines before the shuffle. The links of a source
    with more than `links_per_bucket` of them are spread over several rows, and only its rank is repeated once per row;
    such sources are few by definition. The rank of nodes without links goes to all nodes alike; it is received under
    a null number. What is received is written to the shared folder after each round; a lost executor costs one round. Only
    the last ranks stay there.
    """
    spark = nodes.sparkSession
    paths = [working_path(spark, name) for name in ("links", "nodes", "degrees")]
    links = cut_lineage(links, paths[0])
    numbered = cut_lineage(nodes.select("id").distinct().withColumn("n", F.monotonically_increasing_id()), paths[1])
    degree = cut_lineage(links.groupBy("src").agg(F.count(F.lit(1)).alias("degree")), paths[2])
    n_buckets = F.ceil(F.col("degree") / links_per_bucket).cast("int")
    busy = degree.filter(F.col("degree") > links_per_bucket).select("src", n_buckets.alias("buckets"))
    spread = not busy.isEmpty()
    targets = links.join(numbered.select(F.col("id").alias("dst"), "n"), "dst")
    bucket = F.lit(0)
    if spread:
        targets = targets.join(busy, "src", "left")
        bucket = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("buckets")), F.lit(0)).cast("int")
    lists = targets.select("src", bucket.alias("bucket"), "n").groupBy("src", "bucket").agg(F.collect_list("n").alias("to"))
    sources = numbered.withColumnRenamed("id", "src")
    all_nodes = sources.join(degree, "src", "left").withColumn("degree", F.coalesce("degree", F.lit(0))).join(
        lists.filter("bucket = 0").drop("bucket"), "src", "left"
    ).withColumnRenamed("src", "id")
    further = sources.join(lists.filter("bucket > 0"), "src").drop("src")
    with ExitStack() as kept:
        base = kept.enter_context(bucketed(all_nodes, "n"))
        more = kept.enter_context(bucketed(further, "n", "bucket")) if spread else None
        for path in paths:
            discard(spark, path)
        total, nobody = F.lit(float(base.count())), F.array(F.lit(None).cast("long"))
        ranks, previous = base.withColumn("rank", F.lit(1.0)), None
        for _ in range(iterations):
            parts = ranks.withColumn("part", F.col("rank") / F.greatest("degree", F.lit(1)))
            giving = parts.select("part", F.explode(F.when(F.col("degree") == 0, nobody).otherwise(F.col("to"))).alias("n"))
            if spread:
                rest = parts.filter(F.col("degree") > links_per_bucket).select(
                    "n", "part", F.explode(F.sequence(F.lit(1), n_buckets - 1)).alias("bucket")
                )
                giving = giving.unionByName(more.join(rest, ["n", "bucket"]).select("part", F.explode("to").alias("n")))
            path = working_path(spark, "received")
            received = cut_lineage(giving.groupBy("n").agg(F.sum("part").alias("received")), path)
            if previous:
                discard(spark, previous)
            previous = path
            idle = received.filter("n is null").agg(F.sum("received").alias("idle")).scalar()
            ranks = base.join(received, "n", "left").withColumn(
                "rank",
                F.lit(reset)
                + F.lit(1 - reset)
                * (F.coalesce("received", F.lit(0.0)) + F.coalesce(idle, F.lit(0.0)) / total)
            ).drop("received")
        ranks = cut_lineage(ranks.select(F.col("id").alias("paper_id"), F.col("rank").alias("pagerank")), working_path(spark, "ranks"))
        if previous:
            discard(spark, previous)
    return ranks
