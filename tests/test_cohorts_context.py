from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from edops.operators import cohorts as co
from edops.operators.bi import attention_order, wait_variance_category
from edops.operators.cohorts import build_cohorts, match_cohorts
from edops.operators.context import enrich, expected_wait, wait_context
from edops.operators.gold import kpis, load_15min, median_wait
from edops.operators.running import heavy_keys
from edops.schemas import STORED_STATE

VISIT = "triage_level int, age int, arrival_hour int, waiting_time_minutes double, length_of_stay_minutes double, admitted_flag boolean"


def cohorts_of(spark, rows):
    df = build_cohorts(spark.createDataFrame(rows, VISIT))
    return {r["cohort_key"]: r for r in df.collect()}


def test_two_visits(spark):
    got = cohorts_of(spark, [(3, 30, 10, 10.0, 100.0, False), (3, 31, 10, 30.0, 200.0, True)])
    exact = got["TRIAGE_AGE_HOUR|3|18-44|10"]
    assert (exact["median_wait_minutes"], exact["admission_rate"], exact["patient_count"]) == (20.0, 0.5, 2)
    assert set(got) == {
        "TRIAGE_AGE_HOUR|3|18-44|10", "TRIAGE_AGE|3|18-44|ALL", "TRIAGE|3|ALL|ALL", "OVERALL|ALL|ALL|ALL",
    }


def test_unknown_triage_is_not_the_overall_cohort(spark):
    got = cohorts_of(spark, [(None, None, None, None, 5.0, None), (2, 80, 3, 4.0, None, True)])
    assert got["TRIAGE|ALL|ALL|ALL"]["patient_count"] == 1
    assert got["TRIAGE_AGE_HOUR|ALL|UNKNOWN|ALL"]["avg_wait_minutes"] is None
    assert got["TRIAGE_AGE_HOUR|ALL|UNKNOWN|ALL"]["median_los_minutes"] == 5.0
    overall = got["OVERALL|ALL|ALL|ALL"]
    assert (overall["patient_count"], overall["admission_rate"], overall["avg_wait_minutes"]) == (2, 0.5, 4.0)


def nearest_rank(values, fraction=0.9):
    ordered = sorted(values)
    return ordered[round((len(ordered) - 1) * fraction)]


def test_percentile_and_median_rules(spark):
    rng = random.Random(7)
    rows, waits = [], {}
    for n in range(1, 40):
        waits[n % 24, n] = [float(rng.randint(0, 50)) for _ in range(n)]
        # One group per n: its hour and triage level identify it.
        rows += [(1 + n // 24, 20, n % 24, w, w * 2 + 0.5, None) for w in waits[n % 24, n]]
    got = cohorts_of(spark, rows)
    for (hour, n), values in waits.items():
        row = got[f"TRIAGE_AGE_HOUR|{1 + n // 24}|18-44|{hour}"]
        assert row["patient_count"] == n and row["admission_rate"] == 0.0
        assert row["median_wait_minutes"] == statistics.median(values)
        assert row["p90_wait_minutes"] == nearest_rank(values)
        assert row["p90_los_minutes"] == nearest_rank([v * 2 + 0.5 for v in values])
    assert nearest_rank([1, 2, 3, 4, 5, 6]) == 5


COHORT = "cohort_key string, match_level string, median_wait_minutes double, avg_wait_minutes double, p90_wait_minutes double, admission_rate double"
COHORTS = [
    ("TRIAGE|2|ALL|ALL", "TRIAGE", 20.0, 22.0, 60.0, 0.3),
    ("OVERALL|ALL|ALL|ALL", "OVERALL", 30.0, 35.0, 90.0, 0.1),
]
T0 = datetime(2026, 1, 1)


def state(spark, **values):
    row = {
        "visit_id": "V1", "patient_id": "P1", "arrival_time": T0, "last_event_time": T0 + timedelta(minutes=10),
        "triage_level": 2, "age": 40, "sex": "F", "heart_rate": 90.0, "respiratory_rate": None, "systolic_bp": 120.0,
        "diastolic_bp": None, "spo2": 97.0, "pain_score": None, "current_status": "WAITING", "event_count": 2,
        "waiting_minutes": 50.0,
    }
    row.update(values)
    schema = ", ".join([c for c in STORED_STATE.split(", ") if not c.startswith(("triage_time", "vitals_time"))])
    schema += ", waiting_minutes double"
    return spark.createDataFrame([tuple(row[c.split()[0]] for c in schema.split(", "))], schema)


def score(spark, now=T0 + timedelta(minutes=50), active=1, cohorts=COHORTS, **values):
    known = spark.createDataFrame(cohorts, COHORT)
    return enrich(state(spark, **values), known, F.lit(now).cast("timestamp"), F.lit(active)).first()


def test_fallback_and_score(spark):
    row = score(spark)
    assert (row["historical_match_level"], row["expected_wait_minutes"]) == ("TRIAGE", 20.0)
    assert row["attention_reason"] == ["TRIAGE_LEVEL_2", "WAIT_AT_LEAST_2X_EXPECTED", "NO_UPDATE_OVER_30_MIN"]
    assert (row["attention_score"], row["attention_level"]) == (70, "CRITICAL")
    assert (row["wait_vs_expected_minutes"], row["wait_ratio"], row["historical_p90_wait_minutes"]) == (30.0, 2.5, 60.0)


def test_unknown_or_zero_triage_uses_overall(spark):
    for triage in (None, 0, 4):
        assert score(spark, triage_level=triage)["historical_match_level"] == "OVERALL"


def test_no_cohort_is_an_error(spark):
    with pytest.raises(Exception, match="No cohort matches"):
        score(spark, triage_level=4, cohorts=COHORTS[:1])


@pytest.mark.parametrize(
    "values,reason",
    [
        ({"waiting_minutes": 25.0}, "WAIT_ABOVE_EXPECTED"),  # ratio exactly 1.25
        ({"waiting_minutes": 24.98}, None),
        ({"waiting_minutes": 40.0}, "WAIT_AT_LEAST_2X_EXPECTED"),  # ratio exactly 2
        ({"spo2": 91.9}, "SYNTHETIC_VITAL_FLAG"),
        ({"spo2": 92.0, "heart_rate": 45.0, "systolic_bp": 200.0}, None),
        ({"heart_rate": 44.0}, "SYNTHETIC_VITAL_FLAG"),
        ({"heart_rate": 131.0, "spo2": None}, "SYNTHETIC_VITAL_FLAG"),
        ({"systolic_bp": 79.0, "heart_rate": None}, "SYNTHETIC_VITAL_FLAG"),
        ({"respiratory_rate": 99.0, "diastolic_bp": 10.0, "pain_score": 10.0}, None),
        ({"last_event_time": T0 + timedelta(minutes=20)}, None),  # exactly 30 minutes
        ({"last_event_time": T0 + timedelta(minutes=19, seconds=59)}, "NO_UPDATE_OVER_30_MIN"),
        ({"active": 19}, None),
        ({"active": 20}, "HIGH_ED_LOAD"),
        ({"triage_level": 1}, "TRIAGE_LEVEL_1"),
    ],
)
def test_single_rules(spark, values, reason):
    calm = {"triage_level": None, "waiting_minutes": 0.0, "last_event_time": T0 + timedelta(minutes=50)}
    cohorts = [("OVERALL|ALL|ALL|ALL", "OVERALL", 20.0, 22.0, 60.0, 0.3)]
    row = score(spark, cohorts=cohorts, **{**calm, **values})
    assert row["attention_reason"] == [reason or "NO_OPERATIONAL_ALERT"]


def test_expected_wait_fallback(spark):
    df = spark.createDataFrame([(0.0, 5.0), (None, 0.0), (3.0, 9.0), (0.0, None)], "m double, a double").coalesce(1)
    assert [r[0] for r in df.select(expected_wait(F.col("m"), F.col("a"))).collect()] == [5.0, 0.0, 3.0, 0.0]
    waits = spark.createDataFrame([(None, 5.0), (7.0, 0.0), (1.0, 3.0)], "w double, e double").coalesce(1)
    got = waits.withColumns(wait_context(F.col("w"), F.col("e"))).collect()
    assert [(r["wait_vs_expected_minutes"], r["wait_ratio"]) for r in got] == [(-5.0, 0.0), (7.0, None), (-2.0, 0.333)]


# Published demo visits: triage, minutes since the last update, wait, expected, p90, ratio, score, level, reasons.
GOLDEN = [
    ("2", 105, 171.0, 49.0, 122.0, 3.49, 70, "CRITICAL", ["TRIAGE_LEVEL_2", "WAIT_AT_LEAST_2X_EXPECTED", "NO_UPDATE_OVER_30_MIN"], (70.0, 137.0, 95.0)),
    ("2", 132, 165.0, 9.0, 156.0, 18.333, 70, "CRITICAL", ["TRIAGE_LEVEL_2", "WAIT_AT_LEAST_2X_EXPECTED", "NO_UPDATE_OVER_30_MIN"], (73.0, 98.0, 100.0)),
    ("4", 128, 173.0, 14.0, 159.0, 12.357, 45, "HIGH", ["WAIT_AT_LEAST_2X_EXPECTED", "NO_UPDATE_OVER_30_MIN"], (80.0, 136.0, 99.0)),
    ("4", 127, 169.0, 10.5, 158.5, 16.095, 45, "HIGH", ["WAIT_AT_LEAST_2X_EXPECTED", "NO_UPDATE_OVER_30_MIN"], (96.0, 98.0, 97.0)),
    ("4", 124, 167.0, 20.0, 147.0, 8.35, 45, "HIGH", ["WAIT_AT_LEAST_2X_EXPECTED", "NO_UPDATE_OVER_30_MIN"], (89.0, 100.0, 94.0)),
]


@pytest.mark.parametrize("case", GOLDEN)
def test_published_visits(spark, case):
    triage, idle, wait, expected, variance, ratio, points, level, reasons, (heart, pressure, oxygen) = case
    now = datetime(2026, 8, 24, 21, 7)
    row = score(
        spark, now, 5, [("OVERALL|ALL|ALL|ALL", "OVERALL", expected, 1.0, 84.0, 0.1)], triage_level=int(triage),
        last_event_time=now - timedelta(minutes=idle), waiting_minutes=wait, heart_rate=heart, systolic_bp=pressure, spo2=oxygen,
    )
    assert (row["wait_vs_expected_minutes"], row["wait_ratio"]) == (variance, ratio)
    assert (row["attention_score"], row["attention_level"], row["attention_reason"]) == (points, level, reasons)


def test_match_uses_the_finest_level(spark):
    keys = ["TRIAGE_AGE_HOUR|3|18-44|9", "TRIAGE_AGE|3|18-44|ALL", "TRIAGE|3|ALL|ALL", "OVERALL|ALL|ALL|ALL"]
    cohorts = spark.createDataFrame([(k, k.split("|")[0], 1.0, 1.0, 1.0, 0.0) for k in keys], COHORT)
    df = spark.createDataFrame([(3, 20, 9), (3, 20, 10), (3, 70, 9), (5, 20, 9), (None, None, 0)], "t int, a int, h int").coalesce(1)
    out = match_cohorts(df, cohorts, F.col("t"), F.col("a"), F.col("h"))
    assert [r["cohort"]["match_level"] for r in out.collect()] == ["TRIAGE_AGE_HOUR", "TRIAGE_AGE", "TRIAGE", "OVERALL", "OVERALL"]


EVENT = "event_type string, event_ts timestamp"


def test_load_windows_across_midnight(spark):
    events = spark.createDataFrame(
        [("ARRIVAL", datetime(2026, 1, 1, 23, 59)), ("ARRIVAL", datetime(2026, 1, 1, 23, 50)),
         ("DISCHARGE", datetime(2026, 1, 2, 0, 1)), ("ADMISSION", datetime(2026, 1, 2, 1, 0)),
         ("ADMISSION", datetime(2026, 1, 2, 1, 14, 59)), ("ARRIVAL", datetime(2026, 1, 4, 1, 15))],
        EVENT,
    )
    snapshot = spark.createDataFrame([(3.5, 2)], "avg_wait_minutes double, high_attention_patients long")
    got = [tuple(r) for r in load_15min(events, snapshot).orderBy("window_start").collect()]
    assert got == [
        (datetime(2026, 1, 1, 23, 45), datetime(2026, 1, 2), 2, 2, 0, 0, 3.5, 2),
        (datetime(2026, 1, 2), datetime(2026, 1, 2, 0, 15), 1, 0, 0, 1, 3.5, 2),
        (datetime(2026, 1, 2, 1), datetime(2026, 1, 2, 1, 15), 0, 0, 2, 0, 3.5, 2),
        (datetime(2026, 1, 4, 1, 15), datetime(2026, 1, 4, 1, 30), 0, 1, 0, 0, 3.5, 2),
    ]


def test_kpis_and_empty_state(spark):
    known = spark.createDataFrame(COHORTS, COHORT)
    now = F.lit(T0 + timedelta(minutes=50)).cast("timestamp")
    enriched = enrich(state(spark), known, now, F.lit(1))
    events = spark.createDataFrame([("ARRIVAL", T0), ("DISCHARGE", T0 + timedelta(minutes=30))], EVENT)
    row = kpis(enriched, events).first().asDict()
    assert row == {
        "as_of": T0 + timedelta(minutes=30), "active_patients": 1, "arrivals": 1, "discharges": 1, "admissions": 0,
        "avg_wait_minutes": 50.0, "median_wait_minutes": 50.0, "patients_above_expected_wait": 1, "high_attention_patients": 1,
    }
    empty = kpis(enriched.filter("false"), events).first()
    assert (empty["active_patients"], empty["avg_wait_minutes"], empty["median_wait_minutes"]) == (0, 0.0, 0.0)


def test_median_wait_matches_python(spark):
    rng = random.Random(3)
    for n in (1, 2, 7, 100):
        waits = [round(rng.uniform(0, 400), 2) for _ in range(n)]
        df = spark.createDataFrame([(w,) for w in waits], "waiting_minutes double")
        assert abs(median_wait(df).first()[0] - statistics.median(waits)) <= 0.0051


def test_calculated_fields(spark):
    df = spark.createDataFrame([(0.0, 9.0), (1.0, 2.0), (1.0, 1.9), (1.0, None)], "v double, r double").coalesce(1)
    assert [r[0] for r in df.select(wait_variance_category(F.col("v"), F.col("r"))).collect()] == [
        "At or below expected", "At least 2x expected", "Above expected", "Above expected",
    ]
    levels = spark.createDataFrame([("LOW",), ("MEDIUM",), ("HIGH",), ("CRITICAL",), ("x",)], "l string").coalesce(1)
    assert [r[0] for r in levels.select(attention_order(F.col("l"))).collect()] == [1, 2, 3, 4, 0]


def test_a_million_cohorts_are_joined_by_salted_exchange(spark, monkeypatch):
    """Half of all states ask for one cohort; the finest level is too large to broadcast."""
    finest = spark.range(1_000_000).select(F.concat(F.lit("TRIAGE_AGE_HOUR|3|18-44|"), F.col("id").cast("string")).alias("cohort_key"))
    coarse = spark.createDataFrame([("TRIAGE|2|ALL|ALL",), ("OVERALL|ALL|ALL|ALL",)], "cohort_key string")
    cohorts = finest.union(coarse).withColumn("match_level", F.substring_index("cohort_key", "|", 1))
    states = spark.range(20_000).select(
        "id", F.when(F.col("id") % 10 < 9, 3).otherwise(F.lit(2) + F.floor(F.col("id") % 20 / 10)).cast("int").alias("t"),
        F.lit(30).alias("age"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") + 990_000).cast("int").alias("h"),
    )
    found = []
    monkeypatch.setattr(co, "heavy_keys", lambda df, *keys: found.append(heavy_keys(df, *keys, heavy_rows=2_000)) or found[0])
    got = match_cohorts(states, cohorts, F.col("t"), F.col("age"), F.col("h"))
    assert found == [{"_wanted_TRIAGE_AGE_HOUR": ["TRIAGE_AGE_HOUR|3|18-44|7"]}]
    key = got.select("id", F.col("cohort.cohort_key").alias("key")).collect()
    want = {}
    for i in range(20_000):
        triage = 3 if i % 10 < 9 else 2 + i % 20 // 10
        hour = 7 if i % 2 == 0 else i + 990_000
        exact = f"TRIAGE_AGE_HOUR|3|18-44|{hour}" if hour < 1_000_000 else "OVERALL|ALL|ALL|ALL"
        want[i] = exact if triage == 3 else "TRIAGE|2|ALL|ALL"
    assert {r["id"]: r["key"] for r in key} == want and len(key) == 20_000
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in text and text.count("strategy=broadcast") == 2
