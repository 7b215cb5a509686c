"""Event replay and Gold: events to state, context, KPIs and load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from edops.operators.context import enrich
from edops.operators.events import classify, ledger, stream_counters
from edops.operators.gold import high_water_mark, kpis, load_15min, row_count
from edops.operators.running import SPAN, heavy_keys
from edops.operators.visits import current_rows, fold_visits, open_visits
from edops.schemas import WATERMARK_MINUTES
from edops.session import stage
from edops.sources.sinks import write_laid_out
from edops.streaming.job import VisitStream


@dataclass
class Gold:
    current_ed_state: DataFrame
    ed_kpis: DataFrame
    ed_load_15min: DataFrame


def active_state(
    events: DataFrame, minutes: int = WATERMARK_MINUTES, span: int = SPAN, heavy: dict[str, list] | None = None
) -> DataFrame:
    """Open visits after replaying an ordered list of valid events."""
    # The newest event of all is never late, so the mark needs no classification.
    return current_rows(open_visits(episodes(events, minutes, heavy, span)), high_water_mark(events))


def episodes(
    events: DataFrame, minutes: int = WATERMARK_MINUTES, heavy: dict[str, list] | None = None, span: int = SPAN
) -> DataFrame:
    """Every stay of a replay, open or closed; hot visits are cut in the outcome and in the fold."""
    heavy = heavy_keys(events, "event_id", "visit_id") if heavy is None else heavy
    return fold_visits(classify(events, minutes, heavy, span), heavy, span)


def enriched_state(states: DataFrame, events: DataFrame, cohorts: DataFrame) -> DataFrame:
    return enrich(states, cohorts, high_water_mark(events), row_count(states))


def gold(states: DataFrame, events: DataFrame, cohorts: DataFrame) -> Gold:
    """Enriched state, KPIs and load. ``states`` should be a stored table.

    The enriched state is stored once; KPIs and load read the stored table.
    """
    current = stage(enriched_state(states, events, cohorts), "current_ed_state")
    snapshot = stage(kpis(current, events), "ed_kpis")
    return Gold(current, snapshot, load_15min(events, snapshot))


def write_gold(result: Gold, target: str, replace: bool = True) -> None:
    """Store the three Gold tables by day and in their filter order."""
    tables = {
        "current_ed_state": result.current_ed_state,
        "ed_kpis": result.ed_kpis,
        "ed_load_15min": result.ed_load_15min,
    }
    for name, df in tables.items():
        write_laid_out(df, f"{target}/{name}", name, replace)


def gold_of_stream(stream: VisitStream, cohorts: DataFrame, accepted_only: bool = False) -> Gold:
    """Gold from persisted stream state; an empty event log is an error."""
    log = stream.event_log(accepted_only)
    if log.isEmpty():
        raise ValueError("No accepted streaming events found")
    return gold(stream.open_visits(), log, cohorts)


def evidence(
    parsed: DataFrame, minutes: int = WATERMARK_MINUTES, span: int = SPAN
) -> DataFrame:
    """End-to-end counts of a replay: events, open and closed visits, quality counters."""
    heavy = heavy_keys(parsed.filter(F.size("errors") == 0), "event_id", "visit_id")
    booked = stage(ledger(parsed, minutes, heavy, span), "ledger")
    episodes = fold_visits(booked, heavy, span)
    shape = episodes.agg(
        F.struct(
            F.count_if(~F.col("completed")).alias("active"), F.count_if("completed").alias("completed")
        )
    ).scalar()
    return (
        stream_counters(booked)
        .withColumn("events", row_count(booked))
        .withColumn("_s", shape)
        .select(
            "events",
            F.col("_s.active").alias("active_states"),
            F.col("_s.completed").alias("completed_states"),
            "records_processed",
            "records_rejected",
            "duplicate_event_ids",
            "malformed_events",
            "late_events",
            "missing_fields",
        )
    )


def first_copies(batch: DataFrame) -> DataFrame:
    """One row per event id: the copy that sorts first by all its columns."""
    one = batch.groupBy(F.col("event_id").alias("_id")).agg(F.min(F.struct(*batch.columns)).alias("e"))
    return one.select("e.*")


def append_log(previous: DataFrame, batch: DataFrame) -> DataFrame:
    """Previous log and the batch events whose id it does not know yet."""
    fresh = first_copies(batch).join(previous.select("event_id"), "event_id", "left_anti")
    return previous.unionByName(fresh.select(*previous.columns))


def write_log_batch(
    spark: SparkSession, batch: DataFrame, path: str, batch_id: int, previous: DataFrame | None = None
) -> None:
    """Append a batch's new events as its own partition; a retry replaces it."""
    fresh = first_copies(batch)
    if previous is not None:
        known = previous.filter(F.col("batch_id") != batch_id).select("event_id")
        fresh = fresh.join(known, "event_id", "left_anti")
    fresh.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
