"""Event outcomes and visit state against the SQL replay and hand-made tables."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from edops.operators import events as ev, visits as vs
from edops.operators.running import Running, heavy_keys, running
from edops.plans import replay as jobs
from edops.schemas import PATIENT_EVENTS, STORED_STATE
from sql_fold import replay

T0 = datetime(2026, 1, 1)
VITALS = ["heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", "spo2", "pain_score"]
FIELDS = (
    "event_id string, event_type string, patient_id string, visit_id string, event_ts timestamp, "
    "triage_level int, age int, sex string, heart_rate double, respiratory_rate double, "
    "systolic_bp double, diastolic_bp double, spo2 double, pain_score double, status string, seq long"
)
NAMES = [f.split()[0] for f in FIELDS.split(", ")]
TYPES = ["ARRIVAL", "TRIAGE", "VITALS_UPDATE", "STATUS_UPDATE", "ADMISSION", "DISCHARGE"]


def event(seq, event_id, kind, minute, visit="V1", **values):
    row = dict.fromkeys(NAMES)
    row.update(
        event_id=event_id, event_type=kind, patient_id=f"P-{visit}", visit_id=visit,
        event_ts=T0 + timedelta(minutes=minute), seq=seq, **values,
    )
    return row


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in NAMES) for r in rows], FIELDS)


def random_events(seed, n=300):
    rng = random.Random(seed)
    rows, by_id = [], {}
    for seq in range(n):
        if by_id and rng.random() < 0.15:
            old = dict(rng.choice(list(by_id.values())))
            rows.append({**old, "seq": seq})
            continue
        kind = rng.choices(TYPES, weights=[4, 3, 4, 3, 1, 1])[0]
        # Visit 0 holds a third of all events.
        visit = f"V{0 if rng.random() < 0.34 else rng.randint(1, 9)}"
        values = {}
        if kind in ("TRIAGE", "ARRIVAL") and rng.random() < 0.7:
            values["triage_level"] = rng.randint(1, 5)
        for v in VITALS:
            if rng.random() < (0.5 if kind == "VITALS_UPDATE" else 0.05):
                values[v] = float(rng.randint(10, 200))
        if rng.random() < 0.5:
            values["status"] = rng.choice(["WAITING", "IN_TREATMENT", "", "TRIAGED"])
        if kind == "ARRIVAL":
            values.update(age=rng.choice([None, rng.randint(0, 99)]), sex=rng.choice(["F", "M", None]))
        row = event(seq, f"E{seq}", kind, seq * 2 + rng.randint(-50, 50), visit, **values)
        by_id[row["event_id"]] = row
        rows.append(row)
    return rows


STATE = [f.split()[0] for f in STORED_STATE.split(", ")]


def as_rows(df):
    return sorted((tuple(r[c] for c in STATE) for r in df.select(*STATE).collect()), key=repr)


def expect_rows(states):
    return sorted((tuple(s[c] for c in STATE) for s in states), key=repr)


HEAVY = {"event_id": [f"E{i}" for i in range(0, 300, 3)], "visit_id": ["V0", "V3"]}


@pytest.mark.parametrize("heavy,span", [({}, 1 << 20), (HEAVY, 16)], ids=["plain", "chunked"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_replay_equals_sql(spark, seed, heavy, span):
    rows = random_events(seed)
    outcomes, opened, closed = replay(rows, 30)
    classified = ev.classify(frame(spark, rows), 30, heavy, span)
    got = {r["seq"]: r["outcome"] for r in classified.select("seq", "outcome").collect()}
    assert got == outcomes
    assert len(set(got.values())) == 4
    episodes = vs.fold_visits(classified, heavy, span).cache()
    assert as_rows(vs.open_visits(episodes)) == expect_rows(opened)
    assert as_rows(vs.completed_visits(episodes)) == expect_rows(closed)
    episodes.unpersist()


CONFLICTS = [
    # (event id, minute, expected outcome); every event is an arrival of its own visit
    [("a", 0, "ACCEPTED"), ("a", 500, "DUPLICATE"), ("b", 10, "ACCEPTED")],
    [("a", 100, "ACCEPTED"), ("b", 0, "LATE_EVENT"), ("b", 120, "ACCEPTED"), ("b", 900, "DUPLICATE"), ("c", 95, "ACCEPTED")],
    # Each copy's outcome hangs on the one before.
    [("a", 0, "ACCEPTED"), ("a", 100, "DUPLICATE"), ("b", 20, "ACCEPTED"), ("b", 200, "DUPLICATE"), ("c", 40, "ACCEPTED"),
     ("c", 300, "DUPLICATE"), ("d", 69, "ACCEPTED"), ("e", 38, "LATE_EVENT")],
    [("a", 50, "ACCEPTED"), ("a", 0, "DUPLICATE"), ("a", 50, "DUPLICATE"), ("b", 20, "ACCEPTED"), ("c", 19, "LATE_EVENT")],
]


@pytest.mark.parametrize("heavy,span", [({}, 1 << 20), ({"event_id": ["a", "b"], "visit_id": []}, 2)], ids=["plain", "chunked"])
@pytest.mark.parametrize("case", range(len(CONFLICTS)))
def test_conflicting_copies_do_not_raise_the_mark(spark, case, heavy, span):
    rows = [event(i, name, "ARRIVAL", minute, f"V{i}") for i, (name, minute, _) in enumerate(CONFLICTS[case])]
    classified = ev.classify(frame(spark, rows), 30, heavy, span)
    assert [r["outcome"] for r in classified.orderBy("seq").collect()] == [want for _, _, want in CONFLICTS[case]]


def disputed_events(seed, n, span_minutes=60):
    """Arrivals whose copies carry other times; many outcomes hang on earlier ones."""
    rng = random.Random(seed)
    return [
        event(i, f"E{rng.randint(0, n // 3)}", "ARRIVAL", i + rng.randint(-span_minutes, span_minutes), f"V{i}")
        for i in range(n)
    ]


def one_by_one(rows, minutes):
    """Outcome of each arrival by going through the list."""
    mark, known, out = None, set(), []
    for row in rows:
        if row["event_id"] in known:
            out.append("DUPLICATE")
        elif mark is not None and row["event_ts"] < mark - timedelta(minutes=minutes):
            out.append("LATE_EVENT")
        else:
            known.add(row["event_id"])
            mark = row["event_ts"] if mark is None else max(mark, row["event_ts"])
            out.append("ACCEPTED")
    return out


@pytest.mark.parametrize(
    "seed,heavy,span,fold",
    [(1, {}, 1 << 20, 4_096), (2, {"event_id": [f"E{i}" for i in range(9)], "visit_id": []}, 32, 16)],
    ids=["plain", "chunked"],
)
def test_disputed_copies_are_settled_as_in_order(spark, seed, heavy, span, fold, monkeypatch):
    monkeypatch.setattr(ev.settle, "__defaults__", (ev.SPAN, fold))
    rows = disputed_events(seed, 90)
    classified = ev.classify(frame(spark, rows), 30, heavy, span)
    want = one_by_one(rows, 30)
    assert [r["outcome"] for r in classified.orderBy("seq").collect()] == want
    assert set(want) == {"ACCEPTED", "DUPLICATE", "LATE_EVENT"}


def test_a_chain_of_disputed_copies_takes_few_passes(spark, monkeypatch):
    """Every copy would raise the mark above the next id, were it no duplicate."""
    rows = []
    for i in range(1_000):
        rows += [event(2 * i, f"E{i}", "ARRIVAL", i, f"V{2 * i}"), event(2 * i + 1, f"E{i}", "ARRIVAL", i + 500, f"V{2 * i + 1}")]
    rounds, bounded = [], ev._bounded
    monkeypatch.setattr(ev, "_bounded", lambda *args: rounds.append(1) or bounded(*args))
    classified = ev.classify(frame(spark, rows), 30, {})
    assert [r["outcome"] for r in classified.orderBy("seq").collect()] == one_by_one(rows, 30) == ["ACCEPTED", "DUPLICATE"] * 1_000
    assert len(rounds) <= 2


def test_a_visit_with_a_third_of_all_events_is_cut(spark):
    """The job finds the hot visit itself, cuts it, and gets the uncut result."""
    rows = random_events(9, 400)
    events = frame(spark, rows)
    heavy = heavy_keys(events, "event_id", "visit_id", heavy_rows=100)
    assert heavy["visit_id"] == ["V0"]
    cut = jobs.active_state(events, 30, span=16, heavy=heavy)
    plain = jobs.active_state(events, 30)
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("heavy,span", [({}, 1 << 20), (HEAVY, 8)], ids=["plain", "chunked"])
def test_batches_continue_stored_state(spark, heavy, span):
    rows = random_events(6, 240)
    for row in rows:  # event-time order, as inside a batch
        row["seq"] = 0
    rows.sort(key=lambda r: (r["event_ts"], r["event_id"]))
    for i, row in enumerate(rows):
        row["seq"] = i
    _, opened, _ = replay(rows, None)
    state = spark.createDataFrame([], STORED_STATE)
    for low in range(0, 240, 80):
        part = frame(spark, rows[low : low + 80]).withColumn("late", F.lit(False))
        if low:
            known = frame(spark, rows[:low]).select("event_id").distinct()
            part = part.join(known, "event_id", "left_anti")
        checked = ev.mark_duplicates(part, heavy, span)
        traced = vs.trace_batch(state, checked, heavy, span)
        merged = vs.merge_state(state, traced, heavy, span)
        state = spark.createDataFrame(vs.open_visits(merged).collect(), STORED_STATE)
    assert as_rows(state) == expect_rows(opened)


def outcomes(spark, rows, minutes=30):
    classified = ev.classify(frame(spark, rows), minutes, {})
    return [r["outcome"] for r in classified.orderBy("seq").collect()], classified


def test_lifecycle_closes_the_visit(spark):
    rows = [
        event(0, "1", "ARRIVAL", 0, age=40, status="WAITING"),
        event(1, "2", "TRIAGE", 5, triage_level=2),
        event(2, "3", "VITALS_UPDATE", 10, heart_rate=90.0, spo2=97.0),
        event(3, "4", "DISCHARGE", 60),
    ]
    _, classified = outcomes(spark, rows)
    episodes = vs.fold_visits(classified)
    assert vs.open_visits(episodes).count() == 0
    done = vs.completed_visits(episodes).first()
    assert (done["current_status"], done["triage_level"], done["heart_rate"], done["age"]) == ("DISCHARGE", 2, 90.0, 40)


def test_duplicate_late_and_orphan(spark):
    rows = [
        event(0, "a", "ARRIVAL", 120),
        event(1, "a", "ARRIVAL", 120),
        event(2, "b", "TRIAGE", 60, triage_level=3),
        event(3, "c", "TRIAGE", 121, visit="V2", triage_level=3),
        event(4, "d", "TRIAGE", 90, triage_level=3),  # exactly at the limit: not late
    ]
    kinds, _ = outcomes(spark, rows)
    assert kinds == ["ACCEPTED", "DUPLICATE", "LATE_EVENT", "STATE_WITHOUT_ARRIVAL", "LATE_EVENT"]
    kinds, _ = outcomes(spark, rows[:1] + [event(1, "d", "TRIAGE", 90)])
    assert kinds == ["ACCEPTED", "ACCEPTED"]


def test_older_vitals_do_not_replace_newer(spark):
    rows = [
        event(0, "1", "ARRIVAL", 0),
        event(1, "2", "VITALS_UPDATE", 20, heart_rate=100.0),
        event(2, "3", "VITALS_UPDATE", 10, heart_rate=70.0, spo2=90.0),
    ]
    _, classified = outcomes(spark, rows, 60)
    state = vs.open_visits(vs.fold_visits(classified)).first()
    assert (state["heart_rate"], state["spo2"], state["event_count"]) == (100.0, None, 3)


def test_snapshot_clamps_waiting_at_zero(spark):
    _, classified = outcomes(spark, [event(0, "1", "ARRIVAL", 30)])
    state = vs.open_visits(vs.fold_visits(classified))
    early = vs.current_rows(state, F.lit(T0).cast("timestamp")).first()
    later = vs.current_rows(state, F.lit(T0 + timedelta(minutes=50, seconds=20)).cast("timestamp")).first()
    assert early["waiting_minutes"] == 0.0
    assert later["waiting_minutes"] == later["time_in_ed_minutes"] == 20.33
    assert later["last_update_timestamp"] == T0 + timedelta(minutes=30)


def test_heavy_keys_finds_the_hot_visit(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("visit_id")
    )
    assert heavy_keys(df, "visit_id", heavy_rows=1000) == {"visit_id": ["hot"]}
    assert heavy_keys(df, "visit_id") == {"visit_id": []}
    assert heavy_keys(df.filter("false"), "visit_id") == {"visit_id": []}


@pytest.mark.parametrize("fan,span,levels", [(1 << 16, 64, 1), (4, 8, 5), (2, 16, 8)])
def test_totals_in_levels_equal_the_plain_ones(spark, monkeypatch, fan, span, levels):
    """Chunk totals as a tree: no window without a bounded partition, equal results."""
    from edops.operators import running as module

    monkeypatch.setattr(module, "FAN", fan)
    df = spark.range(900).select(
        (F.col("id") * 3).alias("seq"), (F.col("id") % 5).alias("k"), ((F.col("id") * 37) % 101 - 50).alias("x"), (F.col("id") % 2 == 0).alias("hot")
    )
    df = df.withColumn("k", F.when(F.col("hot"), F.lit(9)).otherwise(F.col("k")))
    measures = [Running("s", "sum", F.col("x")), Running("m", "max", F.col("x"), before=True), Running("low", "min", F.when(F.col("x") > 0, F.col("x")))]
    for keys, heavy in (((), None), (("k",), {"k": [9]})):
        plain = running(df.withColumn("k", F.lit(0)) if not keys else df, "seq", measures, ["k"], {})
        cut = running(df.withColumn("k", F.lit(0)) if not keys else df, "seq", measures, keys, heavy, span, orders=2700)
        assert sorted(map(tuple, cut.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    plan = running(df, "seq", measures, (), None, span, orders=2700)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == levels + 1


def test_running_without_keys_equals_prefix(spark):
    df = spark.range(500).select((F.col("id") * 7).alias("seq"), ((F.col("id") * 37) % 101).alias("x"))
    got = running(
        df, "seq",
        [Running("s", "sum", F.col("x")), Running("m", "max", F.col("x"), before=True), Running("low", "min", F.col("x"))],
        span=64,
    ).orderBy("seq").collect()
    total, top, low = 0, None, None
    for r in got:
        total += r["x"]
        low = r["x"] if low is None else min(low, r["x"])
        assert (r["s"], r["m"], r["low"]) == (total, top, low)
        top = r["x"] if top is None else max(top, r["x"])


def test_schema_has_sixteen_event_fields():
    assert len(PATIENT_EVENTS.split(", ")) == 16
