from __future__ import annotations

import random

import pytest

from corpuslens.operators import entities as en

SCHEMA = "paper_id string, pos int, token string, label string, score double, start int, end int"


def rows_of(seed: int):
    rng = random.Random(seed)
    labels = ["O", "B-ORG", "I-ORG", "I-ORG", "I-MISC", "B-MISC", "I-PER"]
    return [
        (f"p{p}", i, rng.choice(["", "##"]) + f"t{rng.randrange(9)}", rng.choice(labels), rng.random(), i * 5, i * 5 + 4)
        for p in range(30) for i in range(rng.randrange(1, 40))
    ]


def decoded(rows):
    """One token after the other."""
    out, current, last = [], None, None
    for r in sorted(rows):
        if r[0] != last:
            current, last = None, r[0]
        if r[3] == "O":
            current = None
        elif r[3].startswith("B-") or current is None or current["label"] != r[3][2:]:
            current = {"paper": r[0], "span": r[1], "label": r[3][2:], "rows": [r]}
            out.append(current)
        else:
            current["rows"].append(r)
    result = set()
    for s in out:
        text = ""
        for r in s["rows"]:
            text += r[2][2:] if r[2].startswith("##") else (" " + r[2] if text else r[2])
        score = sum(r[4] for r in s["rows"]) / len(s["rows"])
        result.add((
            s["paper"], s["span"], s["label"], text.strip(), round(score, 9), len(s["rows"]), s["rows"][0][5], s["rows"][-1][6],
        ))
    return result


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 4096])
def test_spans_equal_a_sequential_decoder(spark, chunk):
    rows = rows_of(chunk)
    got = en.decode_spans(spark.createDataFrame(rows, SCHEMA), chunk).collect()
    assert {
        (r.paper_id, r.span, r.label, r.text, round(r.score, 9), r.tokens, r.start, r.end) for r in got
    } == decoded(rows)


def test_threshold_and_types(spark):
    rows = [
        ("p", 0, "Deep", "B-ORG", 0.8, 0, 4), ("p", 1, "##Net", "I-ORG", 0.8, 4, 7), ("p", 2, "x", "B-MISC", 0.79, 8, 9),
        ("p", 3, "Ann", "B-PER", 0.99, 10, 13), ("p", 4, "parsing", "I-MISC", 0.9, 14, 20),
    ]
    spans = en.decode_spans(spark.createDataFrame(rows, SCHEMA))
    got = {(r.entity_text, r.entity_type) for r in en.map_entities(spans).collect()}
    assert got == {("DeepNet", "METHOD"), ("parsing", "TASK")}
    lower = {r.entity_text for r in en.map_entities(spans, 0.5).collect()}
    assert lower == {"DeepNet", "parsing", "x"}


def test_longest_dictionary_match_wins(spark):
    texts = spark.createDataFrame([("p", "Use graph neural network models on neural data")], "paper_id string, text string")
    terms = [("neural", "TASK"), ("Graph Neural Network", "METHOD"), ("network models", "TASK"), ("data", "DATASET")]
    got = en.tag_with_dictionary(texts, spark.createDataFrame(terms, "term string, entity_type string")).collect()
    assert {(r.entity_text, r.char_start, r.char_end) for r in got} == {
        ("graph neural network", 1, 4), ("neural", 6, 7), ("data", 7, 8),
    }


def test_first_type_counts_and_arrays(spark):
    mentions = spark.createDataFrame([
        ("p2", "BERT", "TASK", 0.9, 1, 5), ("p1", "bert.", "METHOD", 0.9, 9, 13), ("p1", "Bert", "TASK", 0.9, 20, 24),
    ], "paper_id string, entity_text string, entity_type string, confidence double, char_start int, char_end int")
    row = en.entity_index(mentions).first()
    assert (row.entity, row.entity_type, row.paper_count, row.total_mentions) == ("bert", "METHOD", 2, 3)
    assert {(r.paper_id, r.mentions) for r in en.entity_postings(mentions).collect()} == {("p1", 2), ("p2", 1)}
    arrays = {r.paper_id: (r.methods, r.datasets, r.tasks) for r in en.entity_arrays(mentions).collect()}
    assert arrays == {"p1": (["bert"], [], ["bert"]), "p2": ([], [], ["bert"])}
    none = en.entity_summary(mentions.select("paper_id").limit(0), mentions.limit(0)).first()
    assert none.total_papers == 0 and none.avg_entities_per_paper == 0.0


def test_sections(spark):
    from pyspark.sql import functions as F

    sections = [("Related", "r"), ("3 Methods", "m"), ("Results", ""), ("End", "e"), ("Introduction", "i")]
    df = spark.createDataFrame([(sections, "body" * 900), ([], "body" * 900), (None, "")],
                               "s array<struct<heading: string, text: string>>, f string")
    three = [r[0] for r in df.select(en.prioritise_sections(F.col("s"), F.col("f"), 4)).collect()]
    assert three[0] == "m i r" and len(three[1]) == 3600 and three[2] is None
    cut = df.select(en.prioritise_sections(F.col("s"), F.col("f"), 4, 2000)).collect()
    assert len(cut[1][0]) == 2000


def test_a_model_sees_bounded_batches(spark):
    """10,000 texts reach a task as one Arrow batch; the model gets them in parts, and a long text alone."""
    def load():
        def predict(texts):
            assert len(texts) == 1 or sum(len(t) for t in texts) <= 1 << 12
            return [[{"token": t[:3], "label": "B-ORG", "score": 0.9, "start": 0, "end": 3}] for t in texts]
        return predict

    rows = [(f"p{i}", ("x" * (20000 if i % 97 == 5 else i % 700))) for i in range(2000)]
    texts = spark.createDataFrame(rows, "paper_id string, text string").coalesce(1)
    got = en.tag_with_model(texts, load, chars=1 << 12).collect()
    assert sorted((r.paper_id, r.token) for r in got) == sorted((k, t[:3]) for k, t in rows)


def test_tokens_in_order_are_decoded_without_gathering_them(spark):
    """Places of one paper in several tasks, in turns; repeated places and missing values; and no token travels."""
    rows = rows_of(5)
    turns = spark.createDataFrame(rows[0::2], SCHEMA).coalesce(2).union(spark.createDataFrame(rows[1::2], SCHEMA).coalesce(1))
    shown = lambda df: {(r.paper_id, r.span, r.label, r.text, round(r.score, 9), r.tokens, r.start, r.end) for r in df.collect()}
    assert shown(en.decode_spans(turns)) == decoded(rows)
    twice = rows + [r for r in rows if r[0] in ("p3", "p4")]
    assert shown(en.decode_spans(spark.createDataFrame(twice, SCHEMA), 7)) == decoded(twice)
    gap = [r for r in rows if r[1] % 5 != 3]
    assert shown(en.decode_spans(spark.createDataFrame(gap, SCHEMA))) == decoded(gap)
    missing = spark.createDataFrame([("q", 0, "a", "B-ORG", 0.5, 0, 1), ("q", 1, "b", "I-ORG", None, 1, 2), ("r", 0, "c", "B-ORG", 0.5, 0, 1)], SCHEMA)
    assert {(r.paper_id, r.text, r.tokens) for r in en.decode_spans(missing).collect()} == {("q", "a b", 2), ("r", "c", 1)}
    plan = en._run_pieces(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
