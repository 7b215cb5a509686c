from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edops.functions.times import iso_utc, parse_utc
from edops.operators.contract import flatten_events, parse_events
from edops.operators.events import ledger, quarantine, stream_counters

BASE = '"event_type":"ARRIVAL","event_version":1,"patient_id":"p","visit_id":"v","event_time":"2026-01-01T00:00:00Z"'
OK = '{"event_id":"e",' + BASE + "}"


def parsed(spark, *texts):
    raw = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "raw_value string, seq long")
    return flatten_events(parse_events(raw), ("raw_value", "seq"))


def with_field(text):
    return OK.replace("}", f",{text}}}")


CASES = [
    (OK, []),
    (f"  {OK}\t", []),
    (with_field('"x":{"y":[1,{"z":[2]}]}'), []),
    (OK.replace('"e"', '"br]ace}]"'), []),
    ("not-json", ["MALFORMED_JSON"]),
    ("", ["MALFORMED_JSON"]),
    (None, ["MALFORMED_JSON"]),
    ("[]", ["MALFORMED_JSON"]),
    ("12", ["MALFORMED_JSON"]),
    ("null", ["MALFORMED_JSON"]),
    (OK + "x", ["MALFORMED_JSON"]),
    (OK + " {}", ["MALFORMED_JSON"]),
    (f"{OK},{OK}", ["MALFORMED_JSON"]),
    (OK + "] x [", ["MALFORMED_JSON"]),
    (OK + "} {", ["MALFORMED_JSON"]),
    (OK.replace('"', "'"), ["MALFORMED_JSON"]),
    (OK.replace('"e"', '""'), ["MISSING_EVENT_ID"]),
    (OK.replace('"p"', "null"), ["MISSING_PATIENT_ID"]),
    (OK.replace('"ARRIVAL"', "null"), ["MISSING_EVENT_TYPE", "UNKNOWN_EVENT_TYPE"]),
    (OK.replace('"ARRIVAL"', '"arrival"'), ["UNKNOWN_EVENT_TYPE"]),
    (OK.replace("_version\":1", "_version\":2"), ["UNSUPPORTED_EVENT_VERSION"]),
    (OK.replace("_version\":1", "_version\":\"1\""), ["UNSUPPORTED_EVENT_VERSION"]),
    (OK.replace("_version\":1", "_version\":1.0"), []),
    (OK.replace("_version\":1", "_version\":null"), ["MISSING_EVENT_VERSION", "UNSUPPORTED_EVENT_VERSION"]),
    (OK.replace("2026-01-01T00:00:00Z", "garbage"), ["INVALID_EVENT_TIME"]),
    (OK.replace("2026-01-01T00:00:00Z", "2026"), ["INVALID_EVENT_TIME"]),
    (OK.replace("2026-01-01T00:00:00Z", "2026-02-30T00:00:00Z"), ["INVALID_EVENT_TIME"]),
    (OK.replace("2026-01-01T00:00:00Z", ""), ["MISSING_EVENT_TIME", "INVALID_EVENT_TIME"]),
    (with_field('"triage_level":6'), ["INVALID_TRIAGE"]),
    (with_field('"triage_level":0'), ["INVALID_TRIAGE"]),
    (with_field('"triage_level":2.5'), ["INVALID_TRIAGE"]),
    (with_field('"triage_level":"3"'), ["INVALID_TRIAGE"]),
    (with_field('"triage_level":2.0'), []),
    (with_field('"triage_level":null'), []),
    ('{"event_type":"ARRIVAL"}', [
        "MISSING_EVENT_ID", "MISSING_EVENT_TIME", "MISSING_EVENT_VERSION", "MISSING_PATIENT_ID",
        "MISSING_VISIT_ID", "UNSUPPORTED_EVENT_VERSION", "INVALID_EVENT_TIME",
    ]),
]


def test_error_lists(spark):
    rows = parsed(spark, *[text for text, _ in CASES]).orderBy("seq").collect()
    assert [(r["raw_value"], r["errors"]) for r in rows] == CASES


def test_values_are_typed(spark):
    text = with_field('"triage_level":2.0,"age":40.0,"heart_rate":90,"spo2":"bad","pain_score":3.5,"status":""')
    row = parsed(spark, text.replace("00:00:00Z", "02:30:00.25+02:00")).first()
    assert (row["triage_level"], row["age"], row["heart_rate"], row["spo2"], row["pain_score"], row["status"]) == (2, 40, 90.0, None, 3.5, "")
    assert row["event_ts"] == datetime(2026, 1, 1, 0, 30, 0, 250000)
    assert row["event_version"] == 1


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2026-01-01", datetime(2026, 1, 1)),
        ("2026-01-01T10:20", datetime(2026, 1, 1, 10, 20)),
        ("2026-01-01 10:20:30", datetime(2026, 1, 1, 10, 20, 30)),
        ("2026-01-01T10:20:30.123456-01:30", datetime(2026, 1, 1, 11, 50, 30, 123456)),
        ("January 1", None),
        ("2026-01-01T10:20:30 Europe/Paris", None),
    ],
)
def test_time_parse(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(parse_utc(F.col("t")).alias("ts"))
    assert df.first()["ts"] == expected


def test_time_text(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 9),), (datetime(2026, 1, 1, 9, 0, 0, 5),)], "t timestamp").coalesce(1)
    assert [r[0] for r in df.select(iso_utc(F.col("t"))).collect()] == ["2026-01-01T09:00:00Z", "2026-01-01T09:00:00.000005Z"]


def test_malformed_and_missing_are_counted_and_quarantined(spark):
    booked = ledger(parsed(spark, "not-json", '{"event_type":"ARRIVAL"}', OK, OK), heavy={})
    counts = stream_counters(booked).first().asDict()
    assert counts == {
        "records_processed": 1, "records_rejected": 2, "duplicate_event_ids": 1,
        "malformed_events": 1, "late_events": 0, "missing_fields": 1,
    }
    assert sorted(r["seq"] for r in quarantine(booked).collect()) == [0, 1]


def test_contract_errors_run_no_function_per_element(spark):
    raw = spark.createDataFrame([('{"event_id": 1}',), ("[",), ('{"event_version": "1"}',)], "raw_value string")
    parsed = parse_events(raw)
    assert "lambda" not in parsed._jdf.queryExecution().optimizedPlan().toString()
    errors = {r["raw_value"]: r["errors"] for r in parsed.collect()}
    assert errors["["] == ["MALFORMED_JSON"] and "" not in sum(errors.values(), [])
    assert "MISSING_EVENT_ID" not in errors['{"event_id": 1}'] and "UNSUPPORTED_EVENT_VERSION" in errors['{"event_version": "1"}']
