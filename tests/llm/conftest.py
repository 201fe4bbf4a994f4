from __future__ import annotations

import pytest

#: Rows that every operator must stand: nulls anywhere, blanks, repeats, ties, a long text, columns with clashing names.
LONG = "Word after word, it goes on and on. " * 4000


@pytest.fixture(scope="session")
def odd(spark):
    rows = [
        (1, "The first text has some words in it.", "a"), (1, "The first text has some words in it.", "a"), (2, None, None),
        (3, "", "b"), (None, "A row without an id is a row.", None), (None, None, None), (4, " \t\n ", "c"), (5, LONG, "d"),
        (6, "The first text has some words in it.", "e"), (7, "é ü 漢字 \U0001f600 zero\u200bwidth", "f"),
    ]
    extra = "doc_id long, text string, score string, tokens string, fp string, rule string, kept string, _x string"
    return spark.createDataFrame([(i, t, s, s, s, s, s, s) for i, t, s in rows], extra)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
