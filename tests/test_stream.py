"""The micro-batch job: batches, restarts, retries and the streaming queries."""

from __future__ import annotations

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from edops.operators.events import ledger
from edops.operators.visits import current_rows, fold_visits, open_visits
from edops.plans.replay import gold_of_stream, write_gold, write_log_batch
from edops.schemas import STORED_STATE
from edops.sources.event_stream import file_events, kafka_events, kafka_records
from edops.streaming.job import VisitStream, run_for
from edops.streaming.metrics import BatchMetrics, metrics_table
from sql_fold import replay
from test_events import expect_rows, as_rows, random_events

T0 = datetime(2026, 1, 1)


def text(event_id, kind, minute, visit="V1", **values):
    at = (T0 + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return json.dumps(
        {"event_id": event_id, "event_type": kind, "event_version": 1, "patient_id": f"P-{visit}",
         "visit_id": visit, "event_time": at, **values}
    )


def batch(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "raw_value string").withColumn(
        "ingest_ts", F.lit(T0).cast("timestamp")
    )


def as_text(row):
    values = {k: v for k, v in row.items() if v is not None and k not in ("seq", "event_ts", "event_id", "event_type", "visit_id", "patient_id")}
    minute = (row["event_ts"] - T0).total_seconds() / 60
    return text(row["event_id"], row["event_type"], minute, row["visit_id"], **values)


def outcomes(stream):
    return {(r["batch_id"], r["event_id"]): r["outcome"] for r in stream.ledger().collect()}


def test_checks_across_batches(spark, tmp_path):
    stream = VisitStream(spark, str(tmp_path))
    stream.process(batch(spark, [
        text("a", "ARRIVAL", 120, age=30), text("x", "TRIAGE", 0, "V9", triage_level=2), "oops", text("a", "ARRIVAL", 120, age=30),
    ]), 0)
    stream.process(batch(spark, [
        text("a", "ARRIVAL", 120, age=30),  # known from batch 0
        text("b", "TRIAGE", 89, triage_level=2),  # 31 minutes behind the mark
        text("c", "TRIAGE", 90, triage_level=3),  # exactly at the limit
        text("d", "DISCHARGE", 500, "V2"),
        json.dumps({"event_type": "ARRIVAL"}),
    ]), 1)
    got = outcomes(stream)
    assert got[1, "a"] == "DUPLICATE" and got[1, "b"] == "LATE_EVENT" and got[1, "c"] == "ACCEPTED"
    assert got[1, "d"] == got[0, "x"] == "STATE_WITHOUT_ARRIVAL"
    assert stream.counters().first().asDict() == {
        "records_processed": 4, "records_rejected": 5, "duplicate_event_ids": 2,
        "malformed_events": 1, "late_events": 1, "missing_fields": 1,
    }
    shown = stream.open_visits().first()
    assert (shown["visit_id"], shown["triage_level"], shown["waiting_minutes"]) == ("V1", 3, 380.0)
    kept = stream.quarantine().select("event_id", "raw_value").collect()
    assert len(kept) == 5 and all(r["raw_value"] and (r["event_id"] or "") in r["raw_value"] for r in kept)
    assert stream.ledger().filter("outcome = 'ACCEPTED' and raw_value is not null").isEmpty()
    assert {r["event_id"] for r in stream.event_log().collect()} == {"a", "b", "c", "d", "x"}
    assert {r["event_id"] for r in stream.event_log(accepted_only=True).collect()} == {"a", "c"}


@pytest.mark.parametrize("seed", [11])
@pytest.mark.parametrize("size,heavy_rows", [(240, 1_000_000), (80, 10)], ids=["one_batch", "three_batches_hot"])
def test_batches_equal_sql(spark, tmp_path, seed, size, heavy_rows):
    rows = random_events(seed, 240)
    rows.sort(key=lambda r: r["event_ts"])  # events of one time keep their arrival order
    for i, row in enumerate(rows):
        row["seq"] = i
    _, opened, closed = replay(rows, None)
    for number, low in enumerate(range(0, 240, size)):
        # A new object per batch: nothing but the stored tables carries over.
        stream = VisitStream(spark, str(tmp_path), 10**6, span=32, heavy_rows=heavy_rows)
        stream.process(batch(spark, [as_text(r) for r in rows[low : low + size]]), number)
    assert as_rows(stream.state(number)) == expect_rows(opened)
    assert as_rows(stream.completed()) == expect_rows(closed)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    stream = VisitStream(spark, str(tmp_path))
    first = batch(spark, [text("a", "ARRIVAL", 0, age=30)])
    second = batch(spark, [text("b", "TRIAGE", 5, triage_level=2), text("c", "ARRIVAL", 6, "V2"), text("d", "DISCHARGE", 7, "V2")])
    stream.process(first, 0)
    stream.process(second, 1)
    before = (sorted(map(tuple, stream.open_visits().collect())), stream.counters().first(), outcomes(stream))
    stream.process(second, 1)
    assert before == (sorted(map(tuple, stream.open_visits().collect())), stream.counters().first(), outcomes(stream))
    assert stream.completed().count() == 1
    with pytest.raises(ValueError, match="needs batch 2"):
        stream.process(second, 3)


def test_start_from_a_saved_snapshot(spark, tmp_path):
    first = VisitStream(spark, str(tmp_path / "one"))
    first.process(batch(spark, [text("1", "ARRIVAL", 0, age=40), text("2", "VITALS_UPDATE", 50, heart_rate=80)]), 0)
    snapshot = str(tmp_path / "one" / "episodes" / "batch_id=0" / "completed=false")
    resumed = VisitStream(spark, str(tmp_path / "two"), initial_state=snapshot)
    resumed.process(batch(spark, [text("3", "VITALS_UPDATE", 40, heart_rate=70), text("4", "TRIAGE", 19, triage_level=1)]), 0)
    row = resumed.open_visits().first()
    # The vitals clock is stored, so older vitals stay out; the mark is the last event time.
    assert (row["heart_rate"], row["age"], row["event_count"], row["triage_level"]) == (80.0, 40, 3, None)
    assert outcomes(resumed)[0, "4"] == "LATE_EVENT"


def test_a_snapshot_brings_its_event_ids(spark, tmp_path):
    first = VisitStream(spark, str(tmp_path / "one"))
    update = text("2", "VITALS_UPDATE", 10, heart_rate=80)
    first.process(batch(spark, [text("1", "ARRIVAL", 0), update]), 0)
    saved = str(tmp_path / "snapshot")
    first.write_snapshot(saved)
    resumed = VisitStream(spark, str(tmp_path / "two"), initial_state=f"{saved}/state", initial_ids=f"{saved}/event_ids")
    for number in range(2):
        resumed.process(batch(spark, [update, text(f"new{number}", "TRIAGE", 12 + number, triage_level=2)]), number)
    assert [outcomes(resumed)[n, "2"] for n in range(2)] == ["DUPLICATE"] * 2
    assert resumed.open_visits().first()["event_count"] == 4


def windows(stream):
    return {tuple(r) for r in stream.load_windows().collect()}


def test_load_counts_every_event_once(spark, tmp_path):
    """Many small files per batch, a repeated batch and a batch without its mark."""
    stream = VisitStream(spark, str(tmp_path))
    lines = [text(f"e{i}", "ARRIVAL", i, f"V{i}") for i in range(200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stream.process(batch(spark, lines[:150]).repartition(4), 0)
        stream.process(batch(spark, lines[100:]).repartition(4), 1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    whole = windows(stream)
    assert sum(w[2] for w in whole) == 200 and len(whole) == 14
    stream.process(batch(spark, lines[100:]), 1)
    assert windows(stream) == whole
    (tmp_path / "marks" / "batch_id=1").rename(tmp_path / "lost_mark")
    assert stream.last_batch() == 0
    assert sum(w[2] for w in windows(stream)) == 150 == stream.event_log().count() == stream.ledger().count()


def test_a_batch_without_its_mark_is_not_shown(spark, tmp_path):
    stream = VisitStream(spark, str(tmp_path))
    assert stream.last_batch() is None and stream.ledger().count() == stream.completed().count() == 0
    stream.process(batch(spark, [text("a", "ARRIVAL", 0), "oops"]), 0)
    stream.process(batch(spark, [text("b", "DISCHARGE", 5), "bad"]), 1)
    (tmp_path / "marks" / "batch_id=1").rename(tmp_path / "lost_mark")
    assert (stream.open_visits().count(), stream.completed().count(), stream.quarantine().count()) == (1, 0, 1)
    assert [r["event_id"] for r in stream.event_log().collect()] == ["a"]


def test_stored_batches_are_not_replaced_by_another_run(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_file(source, "1.txt", [text("a", "ARRIVAL", 0)])
    stream = VisitStream(spark, out)
    stream.start_state(file_events(spark, str(source))).awaitTermination()
    before = sorted(map(tuple, stream.ledger().collect()))
    (tmp_path / "out" / "checkpoints").rename(tmp_path / "lost_checkpoints")
    with pytest.raises(Exception, match="another run"):
        VisitStream(spark, out).start_state(file_events(spark, str(source))).awaitTermination()
    assert sorted(map(tuple, stream.ledger().collect())) == before
    again = VisitStream(spark, str(tmp_path / "direct"))
    for number in range(2):
        again.process(batch(spark, [text(f"x{number}", "ARRIVAL", 0, f"V{number}")]), number)
    with pytest.raises(ValueError, match="older than the stored batch 1"):
        again.process(batch(spark, [text("y", "ARRIVAL", 0)]), 0)


def test_event_log_prefers_the_accepted_copy(spark, tmp_path):
    stream = VisitStream(spark, str(tmp_path))
    stream.process(batch(spark, [text("m", "ARRIVAL", 100, "V0")]), 0)
    stream.process(batch(spark, [text("k", "ARRIVAL", 10, "V1")]), 1)  # late
    stream.process(batch(spark, [text("k", "ARRIVAL", 110, "V1")]), 2)  # a copy in time
    log = {r["event_id"]: (r["outcome"], r["batch_id"]) for r in stream.event_log().collect()}
    assert log == {"m": ("ACCEPTED", 0), "k": ("ACCEPTED", 2)}


def test_horizon_keeps_the_decision_on_copies(spark, tmp_path):
    stream = VisitStream(spark, str(tmp_path), dedupe_horizon_minutes=30)
    stream.process(batch(spark, [text("old", "ARRIVAL", 0), text("new", "ARRIVAL", 100, "V2")]), 0)
    stream.process(batch(spark, [text("old", "ARRIVAL", 0), text("new", "ARRIVAL", 100, "V2")]), 1)
    stream.process(batch(spark, [text("far", "ARRIVAL", 900, "V3")]), 2)
    stream.process(batch(spark, [text("new", "ARRIVAL", 100, "V2"), text("far", "ARRIVAL", 900, "V3")]), 3)
    got = outcomes(stream)
    assert (got[1, "old"], got[1, "new"]) == ("LATE_EVENT", "DUPLICATE")
    assert (got[3, "new"], got[3, "far"]) == ("LATE_EVENT", "DUPLICATE")
    assert stream.open_visits().count() == 3


def write_file(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    time.sleep(0.02)


def test_file_stream_with_restart_and_one_more_arrival(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    write_file(source, "1.txt", [text("a", "ARRIVAL", 0), "{bad"])
    write_file(source, "2.txt", [text("b", "ARRIVAL", 5, "V2"), text("c", "DISCHARGE", 20, "V2")])
    stream = VisitStream(spark, out)
    stream.start_state(file_events(spark, str(source))).awaitTermination()
    stream.start_malformed(file_events(spark, str(source))).awaitTermination()
    assert stream.last_batch() == 1
    assert [r["raw_value"] for r in spark.read.json(f"{out}/malformed").collect()] == ["{bad"]
    before = stream.open_visits().count()
    write_file(source, "3.txt", [text("d", "ARRIVAL", 25, "V3"), text("a", "ARRIVAL", 0)])
    again = VisitStream(spark, out)
    again.start_state(file_events(spark, str(source))).awaitTermination()
    assert again.last_batch() == 2
    assert again.open_visits().count() == before + 1
    got = {r["window_start"].hour * 60 + r["window_start"].minute: tuple(r)[2:] for r in again.load_windows().collect()}
    assert got == {0: (2, 0, 0), 15: (1, 0, 1)}

    cohorts = spark.createDataFrame(
        [("OVERALL|ALL|ALL|ALL", "OVERALL", 10.0, 10.0, 20.0, 0.1)],
        "cohort_key string, match_level string, median_wait_minutes double, avg_wait_minutes double, p90_wait_minutes double, admission_rate double",
    )
    gold = gold_of_stream(again, cohorts)
    kpi = gold.ed_kpis.first()
    assert (kpi["active_patients"], kpi["arrivals"], kpi["discharges"]) == (2, 3, 1)
    assert [r["active_patients"] for r in gold.ed_load_15min.orderBy("window_start").collect()] == [2, 2]
    write_gold(gold, str(tmp_path / "gold"))
    assert (tmp_path / "gold" / "current_ed_state" / "partition_date=2026-01-01").is_dir()
    assert spark.read.parquet(str(tmp_path / "gold" / "ed_load_15min")).count() == 2


def test_gold_needs_events(spark, tmp_path):
    stream = VisitStream(spark, str(tmp_path))
    stream.process(batch(spark, ["{bad"]), 0)
    with pytest.raises(ValueError, match="No accepted streaming events"):
        gold_of_stream(stream, spark.createDataFrame([], "cohort_key string"))


def test_bounded_run_and_listener(spark, tmp_path):
    write_file(tmp_path / "in", "1.txt", [text("a", "ARRIVAL", 0)])
    metrics = BatchMetrics()
    spark.streams.addListener(metrics)
    stream = VisitStream(spark, str(tmp_path / "out"))
    run_for(stream.start_state(file_events(spark, str(tmp_path / "in")), available_now=False, every="1 second"), 15)
    spark.streams.removeListener(metrics)
    assert stream.open_visits().count() == 1
    rows = metrics_table(spark, metrics.rows).filter("event = 'batch_0'").collect()
    assert [(r["component"], r["records_processed"]) for r in rows] == [("visit_state", 1)]


def test_list_replay_equals_one_batch_without_late_events(spark, tmp_path):
    lines = [text("a", "ARRIVAL", 0, age=5), text("b", "VITALS_UPDATE", 3, spo2=95), text("c", "ARRIVAL", 4, "V2")]
    stream = VisitStream(spark, str(tmp_path))
    stream.process(batch(spark, lines), 0)
    from edops.operators.contract import flatten_events, parse_events

    raw = spark.createDataFrame(list(enumerate(lines)), "seq long, raw_value string")
    episodes = fold_visits(ledger(flatten_events(parse_events(raw), ("seq",)), heavy={}))
    listed = current_rows(open_visits(episodes), F.lit(T0 + timedelta(minutes=4)).cast("timestamp"))
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, stream.open_visits().collect()))
    assert len(STORED_STATE.split(", ")) == 17


def test_log_partitions_are_replaced_on_retry(spark, tmp_path):
    path = str(tmp_path / "log")
    first = spark.createDataFrame([("a",), ("a",), ("b",)], "event_id string")
    second = spark.createDataFrame([("b",), ("c",)], "event_id string")
    write_log_batch(spark, first, path, 0)
    for _ in range(2):
        write_log_batch(spark, second, path, 1, spark.read.parquet(path))
        rows = sorted(tuple(r) for r in spark.read.parquet(path).select("event_id", "batch_id").collect())
        assert rows == [("a", 0), ("b", 0), ("c", 1)]


def test_kafka_records_and_offsets(spark):
    df = spark.createDataFrame([("e", "V1", None)], "event_id string, visit_id string, age int")
    row = kafka_records(df).first()
    assert row["key"] == "V1" and json.loads(row["value"]) == {"event_id": "e", "visit_id": "V1"}
    with pytest.raises(ValueError, match="earliest or latest"):
        kafka_events(spark, "host:9092", "topic", "middle")
