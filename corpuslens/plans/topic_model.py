"""The topic run: texts to assignments, topic infos and coordinates."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import text as tx
from corpuslens.operators import topics as tp
from corpuslens.session import cut_lineage


class TopicRun(NamedTuple):
    assignments: DataFrame
    info: DataFrame
    coordinates: DataFrame


def fit(
    papers: DataFrame, text: str = "abstract", eps: float = 0.05, min_samples: int = 10,
    min_cluster_size: int = 10, n_words: int = 10, n_topics: int | None = None, dims: int = 256,
    encode=tp.encode_texts,
) -> TopicRun:
    """Clean, encode, project, cluster and label. `encode` maps (paper_id, text) to vectors.

    Clean texts and vectors are read by several passes, so each is written to the shared folder once.
    """
    cleaned = tx.clean_text(papers, text, "_clean")
    docs = cut_lineage(cleaned.select("paper_id", tx.rejoin_sentences(F.col("_clean")).alias("text")))
    points = cut_lineage(tp.project_2d(cut_lineage(encode(docs, dims=dims))))
    topics = cut_lineage(tp.assign_topics(points, eps, min_samples, min_cluster_size))
    counts = tp.topic_word_counts(docs, topics)
    if n_topics is not None:
        merged = tp.reduce_topics(topics, tp.class_tfidf(counts), n_topics)
        topics = cut_lineage(tp.apply_reduction(topics, merged))
        counts = tp.topic_word_counts(docs, topics)
    info = tp.topic_info(topics, tp.topic_terms(tp.class_tfidf(counts), n_words))
    return TopicRun(tp.label_assignments(topics, info), info, points)
