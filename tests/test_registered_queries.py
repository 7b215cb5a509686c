"""Every registered query equals its SQL on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from edops.plans.catalog import QUERIES
from edops.plans.oracles import ORACLES
from compare import compare, connect

DATA = entry.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "attention_score" in df.columns and df.count() >= 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, DATA), con, entry.oracle_sql()[name]) is None


def test_fallback_meets_every_level(spark):
    rows = QUERIES["cohort_fallback"](spark, DATA).groupBy("match_level").count().collect()
    assert {r["match_level"] for r in rows} == {"TRIAGE_AGE_HOUR", "TRIAGE_AGE", "TRIAGE", "OVERALL"}
