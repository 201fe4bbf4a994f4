"""Reading lists: signals, diverse selection, sentence classes and reading categories."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import fixed_values as fixed
from corpuslens.functions import text as tx
from corpuslens.operators.influence import guarded_range

# Cue phrases of the built-in sentence classifier, with the confidence each one carries.
CLASS_CUES = {
    "METHODOLOGY": {"we propose": 0.9, "our method": 0.9, "algorithm": 0.8, "approach": 0.8},
    "LIMITATION": {"limitation": 0.95, "future work": 0.9, "however": 0.8, "remain": 0.75},
    "CONTRIBUTION": {"contribution": 0.95, "we introduce": 0.9, "we present": 0.9, "novel": 0.8},
    "EVALUATION": {"we evaluate": 0.95, "benchmark": 0.85, "experiment": 0.85, "outperform": 0.8},
}


def full_weights(weights: Mapping[str, float] | None = None) -> dict[str, float]:
    """Weights of all five signals: defaults fill the gaps, and the sum becomes one."""
    merged = {**fixed.SIGNAL_WEIGHTS, **(weights or {})}
    total = sum(merged.values())
    return {name: merged[name] / total for name in fixed.SIGNAL_WEIGHTS}


def is_placed_topic(topic: Column) -> Column:
    return F.coalesce(topic, F.lit(-1)) != -1


def recency(day: Column, as_of: Column, decay_days: int = fixed.RECENCY_DAYS) -> Column:
    """Exponential decay of age; future days count as new, unknown ones as nothing."""
    age = F.datediff(as_of, day)
    return F.when(day.isNull(), 0.0).when(age < 0, 1.0).otherwise(F.exp(-age / decay_days))


def score_signals(candidates: DataFrame, as_of: Column) -> DataFrame:
    """Relevance, influence, recency and representativeness in 0..1 for every candidate.

    Centres of topics and extents of queries are aggregates that combine before the shuffle and come back by joins on
    small sides, so a query may have any number of candidates.
    """
    score = F.coalesce("pagerank_score", F.lit(fixed.SCORE_FLOOR))
    centres = candidates.filter(is_placed_topic(F.col("topic_cluster_id"))).groupBy("query_id", "topic_cluster_id").agg(
        F.avg("umap_x").alias("_cx"), F.avg("umap_y").alias("_cy")
    )
    away = F.sqrt(F.pow(F.col("umap_x") - F.col("_cx"), 2) + F.pow(F.col("umap_y") - F.col("_cy"), 2))
    rows = candidates.join(centres, ["query_id", "topic_cluster_id"], "left").withColumn("_distance", away)
    extents = rows.groupBy("query_id").agg(
        F.max("es_score").alias("_top"), F.max(score).alias("_best"), F.max("_distance").alias("_far"),
        F.min("_distance").alias("_near"),
    )
    return rows.join(extents, "query_id", "left").select(
        *candidates.columns,
        F.coalesce(F.try_divide(F.col("es_score"), F.col("_top")), F.lit(0.0)).alias("relevance"),
        ((score - fixed.SCORE_FLOOR) / guarded_range(F.lit(fixed.SCORE_FLOOR), F.col("_best"))).alias("influence"),
        recency(F.col("submitted_date"), as_of).alias("recency"),
        F.coalesce(
            (F.col("_far") - F.col("_distance")) / guarded_range(F.col("_near"), F.col("_far")), F.lit(0.0)
        ).alias("representativeness"),
    )


def _weighted(weights: Mapping[str, float], names: Sequence[str]) -> Column:
    total = F.lit(0.0)
    for name in names:
        total = total + F.lit(weights[name]) * F.col(name)
    return total


def select_diverse(
    scored: DataFrame, n: int = 20, weights: Mapping[str, float] | None = None, digits: int = 9
) -> DataFrame:
    """The greedy choice of `n` papers in which each paper of a topic makes the next one count less.

    Within a topic the choice goes by the fixed part of the score, and the k-th paper gains
    w / (1 + k), which only falls with k. So choosing greedily is sorting by that sum. Both limits
    let Spark drop all but `n` rows per group and task before the shuffle.
    """
    w = full_weights(weights)
    others = [s for s in fixed.SIGNAL_WEIGHTS if s != "diversity"]
    rows = scored.withColumn("base", F.round(_weighted(w, others), digits))
    in_topic = F.row_number().over(
        Window.partitionBy("query_id", F.coalesce("topic_cluster_id", F.lit(-1))).orderBy(
            F.col("base").desc(), F.col("paper_id")
        )
    )
    kept = rows.withColumn("in_topic", in_topic).filter(F.col("in_topic") <= n)
    diversity = F.when(is_placed_topic(F.col("topic_cluster_id")), 1 / F.col("in_topic")).otherwise(0.0)
    total = kept.withColumn("diversity", diversity).withColumn(
        "composite_score", F.round(F.col("base") + F.lit(w["diversity"]) * F.col("diversity"), digits)
    )
    rank = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.col("composite_score").desc(), F.col("paper_id"))
    )
    return total.withColumn("rank", rank).filter(F.col("rank") <= n).drop("base", "in_topic")


def dominant_signal() -> Column:
    """Name of the greatest signal; the first one wins a tie."""
    names = list(fixed.SIGNAL_WEIGHTS)
    best = F.greatest(*names)
    result = F.lit(names[-1])
    for name in reversed(names[:-1]):
        result = F.when(F.col(name) == best, F.lit(name)).otherwise(result)
    return result


def selection_reason(prefix: str = "Top match — ") -> Column:
    """Why a paper was chosen, told from its greatest signal."""
    topic = F.coalesce("topic_cluster", F.lit("this research area"))
    day = F.coalesce(F.date_format("submitted_date", "yyyy-MM-dd"), F.lit("recently"))
    best = dominant_signal()
    text = (
        F.when(best == "relevance", F.format_string("Highly relevant to your query and central to %s", topic))
        .when(
            best == "influence",
            F.format_string("Widely cited foundational work in %s (citation score: %.2f)", topic, F.col("influence")),
        )
        .when(best == "recency", F.format_string("Recent emerging approach in %s published %s", topic, day))
        .when(best == "representativeness", F.format_string("Representative of the %s cluster", topic))
        .otherwise(F.lit("Provides a distinct perspective not covered by other selected papers"))
    )
    return F.when(F.col("rank") == 1, F.concat(F.lit(prefix), text)).otherwise(text)


def assign_categories(selected: DataFrame) -> DataFrame:
    """Reading category of each selected paper, or NULL.

    The first paper of a topic in rank order always gets a category, because its topic is new. So a
    topic is unseen exactly at its first paper.
    """
    cited = F.least(F.lit(1.0), F.log1p(F.coalesce("citation_count", F.lit(0))) / 10)
    first = F.row_number().over(Window.partitionBy("query_id", "topic_cluster_id").orderBy("rank")) == 1
    points = {
        "foundational": 0.7 * F.col("influence") + 0.3 * cited,
        "representative": F.col("representativeness"),
        "emerging": 0.7 * F.col("recency") + 0.3 * F.col("relevance"),
        "contrasting": F.when(is_placed_topic(F.col("topic_cluster_id")) & first, 1.0).otherwise(0.0),
    }
    rows = selected.withColumns({f"as_{name}": value for name, value in points.items()})
    names = [f"as_{name}" for name in fixed.READING_CATEGORIES]
    best = F.greatest(*names)
    category = F.lit(None).cast("string")
    for name in reversed(fixed.READING_CATEGORIES):
        category = F.when(F.col(f"as_{name}") == best, F.lit(name)).otherwise(category)
    return rows.withColumn("category", F.when(best > 0.5, category)).drop(*names)


def cap_per_category(assigned: DataFrame, cap: int = 10) -> DataFrame:
    """At most `cap` papers of each category, in rank order."""
    place = F.row_number().over(Window.partitionBy("query_id", "category").orderBy("rank"))
    return assigned.filter(F.col("category").isNotNull()).withColumn("category_place", place).filter(
        F.col("category_place") <= cap
    )


def category_reason() -> Column:
    topic = F.coalesce("topic_cluster", F.lit("this research area"))
    day = F.coalesce(F.date_format("submitted_date", "yyyy-MM-dd"), F.lit("recently"))
    cites = F.coalesce("citation_count", F.lit(0))
    kind = F.col("category")
    return (
        F.when(
            kind == "foundational",
            F.format_string(
                "Widely cited foundational work in %s with %d citations and high influence score (%.2f)",
                topic, cites, F.col("influence"),
            ),
        )
        .when(
            kind == "representative",
            F.format_string(
                "Central to the %s cluster — closely aligned with the core research direction "
                "(representativeness: %.2f)",
                topic, F.col("representativeness"),
            ),
        )
        .when(
            kind == "emerging",
            F.format_string(
                "Recent work in %s published %s with a strong recency signal (%.2f)", topic, day, F.col("recency")
            ),
        )
        .otherwise(F.format_string(
            "Offers a distinct perspective from a different research cluster — broadens coverage beyond %s", topic
        ))
    )


def classify_with_cues(
    sentences: DataFrame, cues: Mapping[str, Mapping[str, float]] = CLASS_CUES
) -> DataFrame:
    """Class and confidence of each sentence by the strongest cue phrase in it; the built-in model."""
    low = F.lower("sentence")
    found = F.array_compact(F.array(*[
        F.when(F.contains(low, F.lit(phrase)), F.struct(
            F.lit(-confidence).alias("falling"), F.lit(place).alias("place"), F.lit(name).alias("label"),
        ))
        for place, (name, phrases) in enumerate(cues.items())
        for phrase, confidence in phrases.items()
    ]))
    best = F.array_min(found)
    return sentences.withColumn("best", best).select(
        *sentences.columns,
        F.coalesce(F.col("best.label"), F.lit("OTHER")).alias("label"),
        F.coalesce(-F.col("best.falling"), F.lit(0.0)).alias("confidence"),
    )


def classify_with_model(
    sentences: DataFrame, load: Callable[[], Callable[[list[str]], list[tuple[str, float]]]]
) -> DataFrame:
    """Class and confidence by a user's model, loaded once per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            labels = predict(batch["sentence"].tolist())
            yield batch.assign(label=[a for a, _ in labels], confidence=[float(b) for _, b in labels])

    return sentences.select("paper_id", "pos", "sentence").mapInPandas(
        run, "paper_id string, pos int, sentence string, label string, confidence double"
    )


def paper_sentences(papers: DataFrame) -> DataFrame:
    """Clean sentences of the body, or of the abstract where there is no body."""
    cleaned = tx.clean_text(papers, F.coalesce("full_text", "abstract"), "_clean")
    return tx.unfold(cleaned, tx.sentences(F.col("_clean")), "sentence", "paper_id", pos="pos")


def top_sentences(
    classified: DataFrame, threshold: float = fixed.SENTENCE_CONFIDENCE, n: int = fixed.SENTENCES_PER_CLASS
) -> DataFrame:
    """The most confident sentences of each class and paper, one row each."""
    order = Window.partitionBy("paper_id", "label").orderBy(F.col("confidence").desc(), F.col("pos"))
    kept = classified.filter(
        F.col("label").isin(list(fixed.SENTENCE_CLASSES)) & (F.col("confidence") >= threshold)
    )
    return kept.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)


def annotations(top: DataFrame) -> DataFrame:
    """The chosen sentences of each paper as four lists, none longer than the limit above."""

    def listed(label: str) -> Column:
        found = F.collect_list(F.when(F.col("label") == label, F.struct("place", "sentence")))
        return F.transform(F.array_sort(found), lambda s: s["sentence"])

    return top.groupBy("paper_id").agg(*[
        listed(label).alias(name) for label, name in fixed.SENTENCE_CLASSES.items()
    ])


def merge_annotations(selected: DataFrame, notes: DataFrame) -> DataFrame:
    """Selected papers with their lists; papers without any get empty ones."""
    names = list(fixed.SENTENCE_CLASSES.values())
    joined = selected.join(notes.select("paper_id", *names), "paper_id", "left")
    empty = F.array().cast("array<string>")
    return joined.withColumns({n: F.coalesce(F.col(n), empty) for n in names})
