"""Rules that keep every plan distributed."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"
SOURCE = {p: p.read_text() for p in sorted((ROOT / "corpuslens").rglob("*.py")) if p.parent.name != "llm"}


@pytest.mark.parametrize("word", [
    r"localCheckpoint", r"crossJoin", r"toPandas", r"\.toLocalIterator", r"\.rdd\.(?!getNumPartitions)", r"parallelize",
])
def test_library_avoids(word):
    assert [str(p) for p, text in SOURCE.items() if re.search(word, text)] == []


def test_the_driver_only_collects_touched_months():
    found = [(p.name, line.strip()) for p, text in SOURCE.items() for line in text.splitlines() if ".collect()" in line]
    assert found == [("incremental.py", 'months = [r[0] for r in batch.select("ingest_year_month").distinct().collect()]')]


# Plans that run no job before they are returned.
LAZY = [
    "merge_sources", "dedup_edges", "trend_signals", "corpus_stats", "neighbourhood", "paper_detail", "search_many",
    "search_fuzzy", "related_by_topic", "select_diverse", "top_sentences", "decode_spans", "tag_with_dictionary",
    "entity_index", "class_tfidf", "reduce_topics", "series_matrix", "viewport",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_compares_all_pairs(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def plan_of(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    df = entry.queries()["ingest_summary"](spark, SF)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["longest_fulltext", "lookback_newest", "select_diverse", "top_sentences", "search_many"])
def test_ranked_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(spark, name)


def test_first_pages_need_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(spark, "top_influential")
