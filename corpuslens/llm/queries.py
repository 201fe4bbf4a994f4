"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from corpuslens.llm import (
    binary_output, byte_bpe, dialogue, html_text, length_buckets, maxent, nearest, quality, simhash, substrings, toxicity,
    url_filter, variants,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_components": simhash.op1_simhash_components,
    "op2_line_quality": quality.op2_line_quality,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_length_buckets": length_buckets.op4_length_buckets,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_main_text": html_text.op6_main_text,
    "op7_packed_ids": binary_output.op7_packed_ids,
    "op8_nearest_vectors": nearest.op8_nearest_vectors,
    "op9_url_verdicts": url_filter.op9_url_verdicts,
    "op10_maxent_scores": maxent.op10_maxent_scores,
    "op11_repeated_passages": substrings.op11_repeated_passages,
    "op12_repaired_conversations": dialogue.op12_repaired_conversations,
    "op13_spelling_variants": variants.op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op2_line_quality": quality.SQL,
    "op4_length_buckets": length_buckets.SQL,
    "op9_url_verdicts": url_filter.SQL,
    "op11_repeated_passages": substrings.SQL,
    "op13_spelling_variants": variants.SQL,
}
