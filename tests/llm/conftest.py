from __future__ import annotations

import pytest

from llm_helpers import make, prose


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, short, long, equal and near-equal texts, repeated rows."""
    long_text = prose(1, 30_000)
    base = prose(2, 300)
    near = base.split(" ")
    near[150] = "changed"
    return [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, "b"),
        (4, "One two", "en", None),
        (5, "one TWO", "en", None),
        (6, long_text, "en", "b"),
        (7, long_text, "en", "b"),
        (8, base, "en", "a"),
        (9, base, "en", "a"),
        (10, " ".join(near), None, "c"),
        (10, " ".join(near), None, "c"),
        (11, "a " * 400, "en", "c"),
        (12, prose(3, 80) + "\n" + base[200:900], "de", "c"),
        (13, prose(4, 60) + "  xéß " + prose(5, 40), "fr", "a"),
        (None, prose(6, 90), "en", None),
        (14, prose(3, 80) + "\n" + prose(3, 80), "de", "d"),
    ]


@pytest.fixture(params=["plain", "clashing"])
def odd_docs(request, spark, odd_rows):
    return make(spark, odd_rows, request.param == "clashing")


@pytest.fixture
def no_docs(spark):
    return make(spark, [])
