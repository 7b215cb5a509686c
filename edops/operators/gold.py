"""KPI snapshot and 15-minute load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edops.functions.numeric import rnd
from edops.operators.running import Running, running
from edops.schemas import TERMINAL_TYPES

WINDOW_MINUTES = 15
_CENTS_SPAN = 60 * 100  # one hour of waits, in hundredths of a minute


def high_water_mark(events: DataFrame) -> Column:
    """Newest event time as a scalar; the current time when there are no events."""
    return events.agg(F.coalesce(F.max("event_ts"), F.current_timestamp())).scalar()


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def median_wait(states: DataFrame, wait: str = "waiting_minutes") -> DataFrame:
    """Exact median over a histogram of waits in hundredths of a minute.

    Waits have two decimals, so the histogram is exact. Its running count is cut by
    the hour, hence no task sees all visits.
    """
    cents = F.rint(F.col(wait) * 100).cast("long")
    histogram = states.groupBy(cents.alias("cents")).agg(F.count(F.lit(1)).alias("n"))
    ranked = running(histogram, "cents", [Running("reached", "sum", F.col("n"))], span=_CENTS_SPAN, orders=1 << 40)
    last = (row_count(states) - 1).cast("double")

    def at(index: Column) -> Column:
        return F.min(F.when(F.col("reached") > index, F.col("cents"))) / F.lit(100.0)

    middle = (at(F.floor(last / 2)) + at(F.ceil(last / 2))) / F.lit(2.0)
    return ranked.agg(F.coalesce(rnd(middle, 2), F.lit(0.0)).alias("median_wait_minutes"))


def kpis(enriched: DataFrame, events: DataFrame) -> DataFrame:
    """One-row snapshot over open visits and the whole event list."""

    def events_of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind).cast("long")

    flow = events.agg(
        F.coalesce(F.max("event_ts"), F.current_timestamp()).alias("as_of"),
        events_of("ARRIVAL").alias("arrivals"),
        events_of("DISCHARGE").alias("discharges"),
        events_of("ADMISSION").alias("admissions"),
    )
    visits = enriched.agg(
        F.struct(
            F.count(F.lit(1)).alias("active_patients"),
            F.coalesce(rnd(F.avg("waiting_minutes"), 2), F.lit(0.0)).alias("avg_wait_minutes"),
            F.count_if(F.col("wait_vs_expected_minutes") > 0).cast("long").alias("above"),
            F.count_if(F.col("attention_level").isin("HIGH", "CRITICAL")).cast("long").alias("high"),
        )
    ).scalar()
    out = flow.withColumn("_v", visits)
    return out.select(
        "as_of",
        F.col("_v.active_patients").alias("active_patients"),
        "arrivals",
        "discharges",
        "admissions",
        F.col("_v.avg_wait_minutes").alias("avg_wait_minutes"),
        median_wait(enriched).scalar().alias("median_wait_minutes"),
        F.col("_v.above").alias("patients_above_expected_wait"),
        F.col("_v.high").alias("high_attention_patients"),
    )


def window_flow(events: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Arrivals, admissions and discharges per tumbling window that has events."""

    def events_of(kind: str) -> Column:
        return F.count_if(F.col("event_type") == kind).cast("long")

    return (
        events.groupBy(F.window("event_ts", f"{minutes} minutes").alias("w"))
        .agg(
            events_of("ARRIVAL").alias("new_arrivals"),
            events_of("ADMISSION").alias("admissions"),
            events_of("DISCHARGE").alias("discharges"),
            F.count_if(F.col("event_type").isin(TERMINAL_TYPES)).cast("long").alias("ended"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "new_arrivals",
            "admissions",
            "discharges",
            "ended",
        )
    )


def load_windows(events: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Flow per window plus the number of open visits at its end.

    The running total runs over the aggregated windows, cut by the day.
    """
    flow = window_flow(events, minutes).withColumn(
        "_slot", F.floor(F.unix_seconds("window_start") / F.lit(minutes * 60)).cast("long")
    )
    total = running(
        flow,
        "_slot",
        [Running("_open", "sum", F.col("new_arrivals") - F.col("ended"))],
        span=24 * 60 // minutes,
        orders=1 << 33,
    )
    return total.select(
        "window_start",
        "window_end",
        F.greatest(F.lit(0), F.col("_open")).cast("long").alias("active_patients"),
        "new_arrivals",
        "admissions",
        "discharges",
    )


def load_15min(events: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Load windows with the snapshot's average wait and high-attention count."""
    shown = snapshot.select(F.struct("avg_wait_minutes", "high_attention_patients")).scalar()
    ordered = F.assert_true(F.col("window_end") > F.col("window_start"), "Window ends before it starts")
    return (
        load_windows(events)
        .withColumn("_s", shown)
        .filter(ordered.isNull())
        .select(
            "window_start",
            "window_end",
            "active_patients",
            "new_arrivals",
            "admissions",
            "discharges",
            F.col("_s.avg_wait_minutes").alias("avg_wait_minutes"),
            F.col("_s.high_attention_patients").alias("high_attention_count"),
        )
    )
