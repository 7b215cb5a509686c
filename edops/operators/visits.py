"""Fold events into one row per visit episode; merge a micro-batch into stored state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edops.functions.numeric import rnd
from edops.functions.times import minutes_between
from edops.operators.contract import has_vitals
from edops.operators.events import FIRST_EPISODE, outcome, trace_visits
from edops.operators.running import SPAN, Running, running
from edops.schemas import STORED_STATE, TERMINAL_TYPES, VITAL_FIELDS, names

CARRIED = -1  # order of the row that carries a stored visit into a batch
STATE_COLUMNS = names(STORED_STATE)


def _clocked(events: DataFrame) -> DataFrame:
    """Give each event its three clocks: last update, triage and vitals."""
    return events.withColumns(
        {
            "last_time": F.col("event_ts"),
            "triage_time": F.when(F.col("triage_level").isNotNull(), F.col("event_ts")),
            "vitals_time": F.when(has_vitals(), F.col("event_ts")),
            "arrival_time": F.col("event_ts"),
            "weight": F.lit(1).cast("long"),
        }
    )


def fold_episodes(
    live: DataFrame,
    heavy: dict[str, list] | None = None,
    span: int = SPAN,
    terminal: list[str] = TERMINAL_TYPES,
) -> DataFrame:
    """One row per (visit, episode) from accepted, live, clocked rows.

    An update counts when it is not older than every earlier update of its own clock.
    Counting updates never go back in time, so the latest one by order wins and each
    field is a plain ``max_by`` over the order.
    """
    clocks = ["last_time", "triage_time", "vitals_time"]
    seen = running(
        live,
        "seq",
        [Running(f"_{c}", "max", F.col(c), before=True) for c in clocks],
        ["visit_id", "episode"],
        heavy,
        span,
    )

    def counts(clock: str) -> Column:
        newest = F.col(f"_{clock}")
        return F.col(clock).isNotNull() & (newest.isNull() | (F.col(clock) >= newest))

    def latest(value: Column, usable: Column) -> Column:
        order = F.when(usable & value.isNotNull(), F.col("seq"))
        return F.max_by(value, order)

    def opening(value: Column) -> Column:
        return F.min_by(value, F.col("seq"))

    status = F.nullif(F.col("status"), F.lit(""))
    ended = F.max(F.when(F.col("event_type").isin(terminal), F.col("event_type")))
    return (
        seen.groupBy("visit_id", "episode")
        .agg(
            opening(F.col("patient_id")).alias("patient_id"),
            opening(F.col("arrival_time")).alias("arrival_time"),
            F.max("last_time").alias("last_event_time"),
            latest(F.col("triage_level"), counts("triage_time")).alias("triage_level"),
            opening(F.col("age")).alias("age"),
            opening(F.col("sex")).alias("sex"),
            *[latest(F.col(v), counts("vitals_time")).alias(v) for v in VITAL_FIELDS],
            F.coalesce(
                ended,
                latest(status, counts("last_time")),
                opening(F.coalesce(F.col("status"), F.lit("WAITING"))),
            ).alias("current_status"),
            F.sum("weight").alias("event_count"),
            F.max("triage_time").alias("triage_time"),
            F.max("vitals_time").alias("vitals_time"),
            ended.isNotNull().alias("completed"),
        )
        .select(*STATE_COLUMNS, "episode", "completed")
    )


def fold_visits(
    classified: DataFrame, heavy: dict[str, list] | None = None, span: int = SPAN
) -> DataFrame:
    """Episodes of a classified event list (``outcome``, ``episode`` present)."""
    live = classified.filter(F.col("outcome") == "ACCEPTED")
    return fold_episodes(_clocked(live), heavy, span)


def open_visits(episodes: DataFrame) -> DataFrame:
    return episodes.filter(~F.col("completed")).select(*STATE_COLUMNS)


def completed_visits(episodes: DataFrame) -> DataFrame:
    return episodes.filter("completed").select(*STATE_COLUMNS, "episode")


def carry(state: DataFrame) -> DataFrame:
    """Stored visits as the first row of their visit in the next batch."""
    return state.select(
        "visit_id",
        "patient_id",
        F.lit("ARRIVAL").alias("event_type"),
        F.lit(CARRIED).cast("long").alias("seq"),
        "arrival_time",
        F.col("last_event_time").alias("last_time"),
        "triage_level",
        "age",
        "sex",
        *VITAL_FIELDS,
        F.col("current_status").alias("status"),
        F.col("event_count").alias("weight"),
        "triage_time",
        "vitals_time",
    )


def trace_batch(
    state: DataFrame,
    checked: DataFrame,
    heavy: dict[str, list] | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Add ``outcome`` and ``episode`` to batch rows that carry ``duplicate`` and ``late``.

    Each stored visit takes part as the opening row of its visit.
    """
    stored = state.select(
        "visit_id",
        F.lit("ARRIVAL").alias("event_type"),
        F.lit(CARRIED).cast("long").alias("seq"),
        F.lit(False).alias("duplicate"),
        F.lit(False).alias("late"),
    )
    rows = stored.unionByName(checked, allowMissingColumns=True)
    accepted = ~F.col("duplicate") & ~F.col("late")
    traced = trace_visits(rows, accepted, heavy, span)
    return (
        traced.filter(F.col("seq") > CARRIED)
        .withColumn("outcome", outcome())
        .select(*checked.columns, "episode", "outcome")
    )


def merge_state(
    state: DataFrame,
    applied: DataFrame,
    heavy: dict[str, list] | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Episodes after a batch of traced events, of which the accepted ones are applied.

    Stored visits without an event in the batch come back unchanged: their carried row
    folds to itself. Keyed upsert and delete are therefore one grouped pass.
    """
    carried = carry(state).withColumn("episode", F.lit(FIRST_EPISODE).cast("long"))
    batch = _clocked(applied.filter(F.col("outcome") == "ACCEPTED"))
    return fold_episodes(carried.unionByName(batch.select(*carried.columns)), heavy, span)


def current_rows(state: DataFrame, now: Column) -> DataFrame:
    """Snapshot of open visits: waiting and in-department minutes against ``now``."""
    waited = rnd(F.greatest(F.lit(0.0), minutes_between(now, F.col("arrival_time"))), 2)
    clocks = ["triage_time", "vitals_time"]
    return state.select(
        *[c for c in state.columns if c not in clocks],
        waited.alias("waiting_minutes"),
        waited.alias("time_in_ed_minutes"),
        F.col("last_event_time").alias("last_update_timestamp"),
    )
