from __future__ import annotations

import re

import corpus_pipeline
from corpuslens.llm import simhash, toxicity
from corpuslens.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if name == "packing":
            assert out.count() == seen and "batch" in out.columns
        else:
            assert out.columns == columns and 0 < out.count() < seen
        if name == "near_duplicates":
            codes = [r.fp for r in simhash.near_duplicates(out).select("fp").collect()]
            assert len(set(codes)) == len(codes)
        docs, seen = out, out.count()
    last = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in docs.collect())


def test_nothing_is_cut_on_the_way():
    """Stages filter by decisions; no source here samples or limits its input."""
    source = open(corpus_pipeline.__file__).read()
    assert not re.search(r"\.(limit|sample|take)\(", source)
    assert toxicity.FOLDS == 5
