from __future__ import annotations

import unicodedata

import pytest
from pyspark.sql import functions as F

from corpuslens.functions import identifiers as ids
from corpuslens.functions import text as tx
from porter import porter

CASES = [
    ("We use $$a\n+ b$$ and \\[c\\] here", "We use and here"),
    (r"cost is $x_1$ or \(y\) now", "cost is or now"),
    (r"\textbf{bold} \textit{it} \emph{em} \underline{u} \text{t}", "bold it em u t"),
    (r"see \href{http://a.b}{the page} \cite{k} and \ref{r}.", "see the page and ."),
    (r"\alpha* \beta{x} {y}", "x y"),
    ("go to https://a.b/c?d=1 or www.e.f now", "go to or now"),
    ("a\u0000b\u200bc\r\nd\te\u00a0f", "abc d e f"),
    ("cafe\u0301", "caf\u00e9"),
    ("  many   spaces ", "many spaces"),
    (None, ""),
]


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "t string").select(*columns).first()


@pytest.mark.parametrize("raw,want", CASES)
def test_clean(spark, raw, want):
    assert one(spark, raw, tx.clean(F.col("t"), normalise=True))[0] == want


def test_clean_twice_changes_nothing(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "t string")
    once = df.select(tx.clean(F.col("t"), True).alias("t"))
    rows = once.select("t", tx.clean(F.col("t"), True).alias("u")).collect()
    assert all(r.t == r.u and unicodedata.is_normalized("NFC", r.t) for r in rows)


def test_sentences_keep_abbreviations(spark):
    text = "Shown by Li et al. in Fig. 3. It works, e.g. here! Does it? Yes"
    assert one(spark, text, tx.sentences(F.col("t")))[0] == [
        "Shown by Li et al. in Fig. 3.", "It works, e.g. here!", "Does it?", "Yes",
    ]


def test_cue_sentences(spark):
    long = "However, " + "x" * 400 + "."
    text = f"However, short. This sentence has a clear LIMITATION in it. Nothing to see in this one here. {long}"
    found = one(spark, text, tx.cue_sentences(F.col("t")))[0]
    assert found[0] == "This sentence has a clear LIMITATION in it."
    assert len(found) == 2 and len(found[1]) == 280
    assert one(spark, text, tx.cue_sentences(F.col("t"), n=1))[0] == found[:1]


def test_entity_rules(spark):
    df = spark.createDataFrame([("BERT ",), (" \"Bert\",  Large. ",), ("pad12",), ("the",), ("ab",)], "t string")
    rows = df.select(tx.normalise_entity(F.col("t")).alias("n"), tx.is_entity(F.trim("t")).alias("ok")).collect()
    assert [r.n for r in rows[:2]] == ["bert", 'bert", large']
    assert [r.ok for r in rows] == [True, True, False, False, False]


def test_json_strings(spark):
    assert one(spark, '["a", "b"]', tx.json_strings(F.col("t")))[0] == ["a", "b"]
    assert one(spark, "no list", tx.json_strings(F.col("t")))[0] is None


@pytest.mark.parametrize("raw,want", [
    ("2023", "2023-01-01"), ("2023-05-06", "2023-05-06"), ("2024-01-02T03:04:05+00:00", "2024-01-02"),
    ("soon", None), ("", None), (None, None),
])
def test_to_day(spark, raw, want):
    day = one(spark, raw, ids.to_day(F.col("t")))[0]
    assert (day and day.isoformat()) == want


@pytest.mark.parametrize("raw,short,lookup,preprint", [
    ("2401.12345v2", "2401.12345", "ArXiv:2401.12345v2", None),
    ("2401.12345", "2401.12345", "ArXiv:2401.12345", "2401.12345"),
    ("123456", "123456", "123456", None),
])
def test_ids(spark, raw, short, lookup, preprint):
    c = F.col("t")
    got = one(spark, raw, ids.strip_version(c), ids.lookup_id(c), ids.preprint_id(c))
    assert tuple(got) == (short, lookup, preprint)


@pytest.mark.parametrize("word,stem", [
    ("caresses", "caress"), ("ponies", "poni"), ("agreed", "agre"), ("plastered", "plaster"),
    ("motoring", "motor"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"),
    ("relational", "relat"), ("generalizations", "gener"), ("oscillators", "oscil"), ("adoption", "adopt"),
    ("controlling", "control"), ("rate", "rate"), ("cease", "ceas"), ("sky", "sky"), ("is", "is"),
])
def test_porter(word, stem):
    assert porter(word) == stem


def test_only_texts_that_nfc_can_change_reach_python(spark):
    """Every text in another form has a character of the pattern, and plain punctuation has none."""
    odd = [chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFC", chr(c)) != chr(c)]
    made = [unicodedata.normalize("NFD", chr(c)) for c in range(0xC0, 0xD7A4) if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFD", chr(c)) != chr(c)]
    plain = ["It\u2019s \u201cplain\u201d \u2013 caf\u00e9\u2026", "", "\u6f22\u5b57", "\ud55c\uae00"]
    df = spark.createDataFrame([(t,) for t in [*odd, *made, *plain]], "t string").select("t", tx.may_change(F.col("t")).alias("m"))
    assert {r.t for r in df.collect() if r.m} >= {t for t in (*odd, *made) if not unicodedata.is_normalized("NFC", t)}
    assert not any(r.m for r in df.collect() if r.t in plain)
