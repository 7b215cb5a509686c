"""Physical plans: no Python workers, no products, broadcast only where it is bounded."""

from __future__ import annotations

import contextlib
import io

import pytest

from edops.operators import cohorts as co, events as ev, gold as gd, visits as vs
from edops.operators.survey import clean_visits
from edops.plans import fixtures as fx
from edops.plans.replay import enriched_state
import __spark_entry__ as entry

DATA = entry.SMOKE_DIR
LAZY = [
    "fixed_width_parse", "quality_flags", "dq_report", "cohort_rollup", "event_validation", "dedupe_events",
    "episodes", "active_state", "cohort_fallback", "event_log_append",
]


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_workers_and_no_products(spark, name):
    text = plan(entry.queries()[name](spark, DATA))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert node not in text, node


def test_cohorts_are_broadcast_once(spark):
    states = spark.createDataFrame(
        vs.current_rows(vs.open_visits(vs.fold_visits(ev.classify(fx.events(spark, DATA), 180, {}))), gd.high_water_mark(fx.events(spark, DATA))).collect(),
        "visit_id string, patient_id string, arrival_time timestamp, last_event_time timestamp, triage_level int, age int, sex string, heart_rate double, respiratory_rate double, systolic_bp double, diastolic_bp double, spo2 double, pain_score double, current_status string, event_count long, waiting_minutes double, time_in_ed_minutes double, last_update_timestamp timestamp",
    )
    df = enriched_state(states, fx.events(spark, DATA), co.build_cohorts(fx.visits(spark, DATA)))
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("BroadcastHashJoin LeftOuter") == 3
    assert final.count("ReusedExchange") >= 2
    assert "SortMergeJoin" not in final


def test_scans_read_only_needed_columns(spark):
    text = plan(entry.queries()["cohort_rollup"](spark, DATA))
    schema = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema


def test_visit_fold_shuffles_each_key_once(spark):
    """Late order, event id, visit id: three exchanges of rows, one of chunk totals."""
    text = plan(vs.fold_visits(ev.classify(fx.events(spark, DATA), 180, {}, fx.ORDER_SPAN)))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") <= 6


def test_heavy_keys_are_cut_into_chunks(spark):
    heavy = {"event_id": [], "visit_id": ["V1"]}
    classified = ev.classify(fx.events(spark, DATA), 180, heavy, fx.ORDER_SPAN)
    text = plan(vs.fold_visits(classified, heavy, fx.ORDER_SPAN))
    window = next(line for line in text.splitlines() if "windowspecdefinition" in line)
    assert "_chunk#" in window and "SinglePartition" not in text


def test_silver_moves_rows_once(spark, tmp_path):
    fx.records(spark, DATA).write.parquet(str(tmp_path / "bronze"))
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    tree = plan(clean_visits(stored, "record_order", [])).split("\n\n")[0]
    assert tree.count("Exchange") == 1


def test_events_are_searched_once_a_row(spark):
    rows = fx.events(spark, DATA)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract(") == 1


def test_counters_store_no_raw_text(spark, monkeypatch):
    from edops.plans import catalog

    stored = {}
    stage = catalog.stage
    monkeypatch.setattr(catalog, "stage", lambda df, name: stored.setdefault(name, df.columns) and stage(df, name))
    catalog.QUERIES["dq_streaming"](spark, DATA)
    assert "raw_value" not in stored["parsed"] and set(catalog.EVENT_COLUMNS) <= set(stored["parsed"])
