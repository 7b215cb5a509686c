"""Id index, state in buckets and the load stream: results, and what a batch opens."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from edops.sources import folders
from edops.sources.event_stream import file_events
from edops.streaming import ids as index
from edops.streaming.ids import IdIndex
from edops.streaming.job import VisitStream
from edops.streaming.parts import PartTable
from test_stream import T0, batch, outcomes, text, write_file


def id_rows(spark, names):
    return spark.createDataFrame([(n, T0) for n in names], "event_id string, event_ts timestamp")


def test_index_finds_copies_and_opens_few_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "FAN", 3)
    known, segments, opened = IdIndex(spark, str(tmp_path)), [], []
    for number in range(10):
        asked = id_rows(spark, [f"{number}-{i}" for i in range(40)])
        parts = known.parts_of(asked.select("event_id"), segments)
        opened.append(sum(len(b) for b in parts.values()))
        segments = known.add(asked, number, segments, 40)
    # New ids open next to nothing, however many batches lie behind; base 3: 10 = 1 * 9 + 1.
    assert max(opened) <= 2 and [(s.first, s.batches, s.ids) for s in segments] == [(0, 9, 360), (9, 1, 40)]
    some = spark.createDataFrame([("4-7",), ("9-39",), ("new",), ("x" * 5000,)], "event_id string")
    parts = known.parts_of(some, segments)
    assert {s.first for s in parts} == {0, 9} and sum(len(b) for b in parts.values()) <= 3
    found = known.known(some, segments)
    assert {"4-7", "9-39"} <= {r["event_id"] for r in found.collect()}
    assert found.count() < 60  # parts, not the whole log
    assert len(found.inputFiles()) <= 3
    assert known.all(segments).count() == 400
    again = known.add(id_rows(spark, ["late"]), 9, segments[:-1], 1)
    assert (again[-1].first, again[-1].ids) == (9, 1) and known.all(again).count() == 361


def test_filters_hold_every_id(spark, tmp_path):
    known = IdIndex(spark, str(tmp_path))
    names = [f"id-{i}" for i in range(5000)]
    segments = known.add(id_rows(spark, names), 0, [], 5000)
    found = known.known(spark.createDataFrame([(n,) for n in names[::7]], "event_id string"), segments)
    assert set(names[::7]) <= {r["event_id"] for r in found.collect()}
    other = spark.createDataFrame([(f"other-{i}",) for i in range(300)], "event_id string")
    assert sum(map(len, known.parts_of(other, segments).values())) <= 2
    assert known.known(other, []).count() == 0 and known.parts_of(other.limit(0), segments) == {}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    stream = VisitStream(spark, str(tmp_path), 10**6)
    stream.process(batch(spark, [text(f"a{i}", "ARRIVAL", i, f"V{i}", age=i) for i in range(60)]), 0)
    everything = {r["visit_id"]: tuple(r) for r in stream.state(0).collect()}
    stream.process(batch(spark, [text("t", "TRIAGE", 70, "V7", triage_level=2)]), 1)
    first, second = stream._open.live(0), stream._open.live(1)
    assert len(first) > 20 and set(first.values()) == {0}
    assert [b for b in second if second[b] != 0] == [b for b, v in second.items() if v == 1] and sum(second.values()) == 1
    # Only that bucket is read and written, whatever the number of open visits.
    assert len(stream.state(1, [b for b, v in second.items() if v == 1]).inputFiles()) == 1
    assert len(folders.children(spark, str(tmp_path / "episodes" / "batch_id=1" / "completed=false"))) == 1
    now = {r["visit_id"]: tuple(r) for r in stream.state(1).collect()}
    assert set(now) == set(everything) and {v for v in now if now[v] != everything[v]} == {"V7"}
    # The last visit of a bucket leaves: the bucket is gone; older states stay readable.
    stream.process(batch(spark, [text(f"d{i}", "DISCHARGE", 80 + i, f"V{i}") for i in range(60)]), 2)
    assert stream._open.live(2) == {} and stream.state(2).count() == 0 and stream.completed().count() == 60
    assert stream.state(1).count() == 60
    stream.process(batch(spark, ["{bad"]), 3)
    assert stream.state(3).count() == 0
    stream.process(batch(spark, [text("a3", "ARRIVAL", 3, "V3"), text("n", "ARRIVAL", 200, "V3")]), 4)
    assert outcomes(stream)[4, "a3"] == "DUPLICATE" and [r["visit_id"] for r in stream.state(4).collect()] == ["V3"]


def test_part_table_versions(spark, tmp_path):
    table = PartTable(spark, str(tmp_path / "m"), "k string, n long", "part", lambda v: str(tmp_path / f"v{v}"))
    rows = lambda *r: spark.createDataFrame(r, "k string, n long, part string")
    assert table.newest() is None and table.read(None).count() == 0
    table.write(rows(("a", 1, "x"), ("b", 2, "y")), 0, ["x", "y"], None)
    table.write(rows(("a", 5, "x")), 1, ["x", "z"], 0)
    table.write(rows(("q", 1, "w")), 2, ["y", "w"], 1)
    assert [sorted(map(tuple, table.read(v).collect())) for v in range(3)] == [
        [("a", 1), ("b", 2)], [("a", 5), ("b", 2)], [("a", 5), ("q", 1)],
    ]
    assert table.newest() == 2 and table.read(2, ["y"]).count() == 0 and table.read(1, ["y", "none"]).count() == 1
    # A version whose manifest was not written is not there.
    rows(("c", 9, "x")).write.partitionBy("part").parquet(str(tmp_path / "v3"))
    assert table.newest() == 2 and table.live(3) == {}


def windows_of(frame):
    return {tuple(r) for r in frame.select("window_start", "window_end", "new_arrivals", "admissions", "discharges").collect()}


@pytest.mark.parametrize("files", [None, 1], ids=["all_at_once", "one_by_one"])
def test_load_stream_equals_the_batches(spark, tmp_path, files):
    """Copies, late events, a change of an older window, midnight, and a restart of both queries."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    day = 24 * 60
    write_file(source, "1.txt", [text("a", "ARRIVAL", day - 16), text("b", "ARRIVAL", day - 1, "V2"), text("b", "ARRIVAL", day - 1, "V2"), "{bad"])
    write_file(source, "2.txt", [text("c", "DISCHARGE", day + 1, "V2"), text("a", "ARRIVAL", day - 16), text("d", "ARRIVAL", day - 14, "V3")])
    write_file(source, "3.txt", [text("e", "ADMISSION", day + 100, "V3")])
    VisitStream(spark, out).start_state(file_events(spark, str(source))).awaitTermination()
    stream = VisitStream(spark, out)
    stream.start_load(files=files).awaitTermination()
    assert windows_of(stream.stored_load()) == windows_of(stream.load_windows())
    before = stream._load_table.newest()
    write_file(source, "4.txt", [text("f", "ARRIVAL", day + 80, "V9"), text("late", "ARRIVAL", day, "V8"), text("e", "ADMISSION", day + 100, "V3")])
    again = VisitStream(spark, out)
    again.start_state(file_events(spark, str(source))).awaitTermination()
    again.start_load(files=files).awaitTermination()
    got = windows_of(again.stored_load())
    at = lambda minute: T0 + timedelta(minutes=minute)
    assert got == windows_of(again.load_windows()) == {
        (at(day - 30), at(day - 15), 1, 0, 0), (at(day - 15), at(day), 2, 0, 0), (at(day), at(day + 15), 0, 0, 1),
        (at(day + 75), at(day + 90), 1, 0, 0), (at(day + 90), at(day + 105), 0, 1, 0),
    }
    # Only the day that changed was written; a repeated micro-batch leaves the same table.
    live, newest = again._load_table.live(again._load_table.newest()), again._load_table.newest()
    assert newest > before and live["2026-01-01"] <= before < live["2026-01-02"]
    again.upsert_load(again.stored_load().filter(F.col("window_start") >= F.lit(at(day))), newest)
    assert windows_of(again.stored_load()) == got


def test_a_complete_batch_is_not_computed_again(spark, tmp_path):
    """A crash between mark and load: the repeat only adds the load, from the stored ledger."""
    stream = VisitStream(spark, str(tmp_path))
    lines = batch(spark, [text("a", "ARRIVAL", 0), text("b", "ARRIVAL", 20, "V2")])
    stream.process(lines, 0)
    whole = windows_of(stream.load_windows())
    (tmp_path / "load" / "batch_id=0").rename(tmp_path / "lost_load")
    assert windows_of(stream.load_windows()) == set()
    stream.process(lines, 0)
    assert windows_of(stream.load_windows()) == whole and stream.ledger().count() == 2


def test_documents_replace_one_another(spark, tmp_path):
    path = str(tmp_path / "deep" / "er" / "x.json")
    assert folders.read_document(spark, path) is None and folders.children(spark, str(tmp_path / "none")) == []
    for value in ({"a": [1, 2]}, {"é": None}, []):
        folders.write_document(spark, path, value)
        assert folders.read_document(spark, path) == value
    assert folders.children(spark, str(tmp_path / "deep" / "er")) == ["x.json"]
    with pytest.raises(FileExistsError):
        folders.write_whole(spark.range(1), str(tmp_path / "deep" / "er"))
