"""Historical context and the operational attention score (not clinical advice)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edops.functions.numeric import first_non_zero, rnd, safe_ratio
from edops.functions.times import minutes_between
from edops.operators.cohorts import match_cohorts

# Fixed values: (lowest score, level), highest first.
ATTENTION_LEVELS = [(70, "CRITICAL"), (45, "HIGH"), (20, "MEDIUM")]
LOWEST_LEVEL = "LOW"
NO_ALERT = "NO_OPERATIONAL_ALERT"
STALE_MINUTES = 30
BUSY_VISITS = 20


def expected_wait(median: Column, mean: Column) -> Column:
    """Median, else mean, else 0; a zero counts as missing."""
    return first_non_zero(median, mean)


def wait_context(wait: Column, expected: Column) -> dict[str, Column]:
    wait = F.coalesce(wait.cast("double"), F.lit(0.0))
    return {
        "wait_vs_expected_minutes": rnd(wait - expected, 2),
        "wait_ratio": safe_ratio(wait, expected, 3),
    }


def abnormal_vitals() -> Column:
    """Out-of-range oxygen saturation, heart rate or systolic pressure; NULL is normal."""
    low_oxygen = F.col("spo2") < 92
    heart = ~F.col("heart_rate").between(45, 130)
    pressure = ~F.col("systolic_bp").between(80, 200)
    return F.coalesce(low_oxygen, F.lit(False)) | F.coalesce(heart, F.lit(False)) | F.coalesce(
        pressure, F.lit(False)
    )


def attention_rules(now: Column, active: Column) -> list[tuple[Column, int, str]]:
    """(condition, points, reason) in the order in which reasons are listed."""
    triage, ratio = F.col("triage_level"), F.col("wait_ratio")
    return [
        (triage == 1, 40, "TRIAGE_LEVEL_1"),
        (triage == 2, 25, "TRIAGE_LEVEL_2"),
        (ratio >= 2, 30, "WAIT_AT_LEAST_2X_EXPECTED"),
        ((ratio >= 1.25) & (ratio < 2), 15, "WAIT_ABOVE_EXPECTED"),
        (abnormal_vitals(), 20, "SYNTHETIC_VITAL_FLAG"),
        (minutes_between(now, F.col("last_event_time")) > STALE_MINUTES, 15, "NO_UPDATE_OVER_30_MIN"),
        (active >= BUSY_VISITS, 10, "HIGH_ED_LOAD"),
    ]


def attention_level(score: Column) -> Column:
    level = F.lit(LOWEST_LEVEL)
    for floor, label in reversed(ATTENTION_LEVELS):
        level = F.when(score >= floor, label).otherwise(level)
    return level


def score_attention(states: DataFrame, now: Column, active: Column) -> DataFrame:
    """Add score, level and ordered reasons."""
    rules = attention_rules(now, active)
    points = [F.when(condition, F.lit(p)).otherwise(F.lit(0)) for condition, p, _ in rules]
    score = points[0]
    for point in points[1:]:
        score = score + point
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(reason)) for c, _, reason in rules]))
    return (
        states.withColumn("attention_score", score.cast("int"))
        .withColumn("attention_level", attention_level(F.col("attention_score")))
        .withColumn("attention_reason", reasons)
        .withColumn(
            "attention_reason",
            F.when(F.size("attention_reason") == 0, F.array(F.lit(NO_ALERT))).otherwise(
                F.col("attention_reason")
            ),
        )
    )


def enrich(states: DataFrame, cohorts: DataFrame, now: Column, active: Column) -> DataFrame:
    """Open visits with their cohort, expected wait and attention score."""
    matched = match_cohorts(
        states, cohorts, F.col("triage_level"), F.col("age"), F.hour("arrival_time")
    )
    with_wait = matched.select(
        *states.columns,
        F.col("cohort.cohort_key").alias("historical_cohort_key"),
        F.col("cohort.match_level").alias("historical_match_level"),
        expected_wait(F.col("cohort.median_wait_minutes"), F.col("cohort.avg_wait_minutes")).alias(
            "expected_wait_minutes"
        ),
        F.col("cohort.p90_wait_minutes").cast("double").alias("historical_p90_wait_minutes"),
        F.col("cohort.admission_rate").cast("double").alias("historical_admission_rate"),
    )
    compared = with_wait.withColumns(
        wait_context(F.col("waiting_minutes"), F.col("expected_wait_minutes"))
    )
    return score_attention(compared, now, active)
