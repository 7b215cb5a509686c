from __future__ import annotations

import hashlib
import re
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edops.operators.cohorts import age_band
from edops.operators.quality import quality_report
from edops.operators.survey import clean_visits, diagnosis_group
from edops.plans import catalog, fixtures, historical
from edops.schemas import CLEAN_VISITS, RECORD_WIDTH, SURVEY_LAYOUT
from edops.session import stage
from edops.sources import sinks
from edops.sources.fixed_width import read_bronze
from edops.sources.sinks import write_table

STAMP = datetime(2026, 1, 1)


def record(**values) -> str:
    """A fixed-width line: the given texts, right-aligned in their fields, blanks elsewhere."""
    fields = sorted((*SURVEY_LAYOUT[name], str(text)) for name, text in values.items())
    line = ""
    for start, width, text in fields:
        line = f"{line:<{start - 1}}{text:>{width}}"
    return f"{line:<{RECORD_WIDTH}}"


def bronze(spark, *records):
    rows = [(r, i + 1, STAMP) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "raw_record string, source_row_number long, ingestion_timestamp timestamp")


def whole_plan(spark, df) -> str:
    """The optimised plan with all columns of every step."""
    old = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        return df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", old)


def clean(spark, *records):
    return clean_visits(bronze(spark, *records), heavy=[]).orderBy("source_record_id").collect()


def test_every_field_of_a_valid_record(spark):
    given = {
        "visit_month": "11", "visit_weekday": "5", "arrival_time": "0715", "waiting_time_minutes": "0012",
        "length_of_stay_minutes": "0333", "age": "071", "sex": "1", "triage_level": "02", "temperature_f": "1013",
        "heart_rate": "118", "respiratory_rate": "026", "systolic_bp": "099", "diastolic_bp": "061", "spo2": "091",
        "pain_score": "08", "reason_for_visit_code": "19052", "diagnosis_code": "J189", "admit_hospital": "1",
        "patient_weight": "88.25",
    }
    known = {k: v for k, v in given.items() if k in SURVEY_LAYOUT}
    row = clean(spark, record(**known))[0].asDict()
    want = {
        "visit_month": 11, "visit_weekday": "Thursday", "weekend_flag": False, "arrival_hour": 7, "age": 71, "sex": "F",
        "waiting_time_minutes": 12.0, "length_of_stay_minutes": 333.0, "triage_level": 2, "temperature": 101.3,
        "heart_rate": 118.0, "respiratory_rate": 26.0, "systolic_bp": 99.0, "diastolic_bp": 61.0, "spo2": 91.0,
        "pain_score": 8.0, "chief_complaint": "RFV_CODE:19052", "diagnosis_code": "J189", "source_weight": 88.25,
        "patient_id": None, "arrival_time": None, "diagnosis_description": None, "data_quality_flags": [],
        "data_quality_status": "VALID", "source_record_id": "2022-000001",
        "visit_id": "NHAMCS-" + hashlib.sha256(b"CDC_NHAMCS_ED:2022-000001").hexdigest()[:20],
    }
    assert list(row) == CLEAN_VISITS
    assert {k: row[k] for k in want} == want


def test_invalid_vitals_are_flagged_and_kept(spark):
    row = clean(spark, record(age="025", heart_rate="000", spo2="120", systolic_bp="060", diastolic_bp="080"))[0]
    assert row["data_quality_flags"] == ["INVALID_HEART_RATE", "INVALID_SPO2", "INVALID_BP_RELATION"]
    assert row["data_quality_status"] == "FLAGGED" and row["heart_rate"] == 0.0


def test_missing_codes_and_odd_text(spark):
    rows = clean(
        spark,
        record(age="-9", triage_level="07", waiting_time_minutes="1.5", arrival_time="-9", patient_weight="n/a", sex="9"),
        record(visit_weekday="1", heart_rate="\t72", patient_weight="-1.5", arrival_time="0930", triage_level="0"),
        record(visit_weekday="7", patient_weight="1.5d", temperature_f="abc", arrival_time="12 0"),
        record(patient_weight="inf", spo2="\x1c97"),
    )
    first = rows[0]
    assert [first[c] for c in ("age", "triage_level", "waiting_time_minutes", "arrival_hour", "source_weight", "sex", "visit_weekday")] == [None] * 7
    assert first["weekend_flag"] is False and first["disposition"] is None and first["admitted_flag"] is False
    assert (rows[1]["weekend_flag"], rows[1]["heart_rate"], rows[1]["source_weight"], rows[1]["arrival_hour"]) == (True, 72.0, None, 9)
    assert (rows[2]["weekend_flag"], rows[2]["source_weight"], rows[2]["temperature"], rows[2]["arrival_hour"]) == (True, None, None, None)
    assert rows[3]["source_weight"] == float("inf") and rows[3]["spo2"] == 97.0


@pytest.mark.parametrize(
    "flags,expected",
    [
        (["observation_hospitalized", "died_in_ed"], ("ADMITTED", True)),
        (["died_in_ed", "dead_on_arrival"], ("DIED_IN_ED", False)),
        (["dead_on_arrival", "transfer_psych"], ("DEAD_ON_ARRIVAL", False)),
        (["transfer_nursing", "left_without_seen"], ("TRANSFERRED", False)),
        (["left_without_seen", "left_before_complete"], ("LEFT_WITHOUT_BEING_SEEN", False)),
        (["left_before_complete", "left_ama"], ("LEFT_BEFORE_COMPLETE", False)),
        (["left_ama", "observation_discharged"], ("LEFT_AGAINST_MEDICAL_ADVICE", False)),
        (["observation_discharged", "return_ed"], ("OBSERVATION_DISCHARGED", False)),
        (["return_refer", "other_disposition"], ("DISCHARGED", False)),
        (["other_disposition"], ("OTHER", False)),
    ],
)
def test_disposition_precedence(spark, flags, expected):
    row = clean(spark, record(**dict.fromkeys(flags, "1")))[0]
    assert (row["disposition"], row["admitted_flag"]) == expected


def test_record_numbers_grow_past_six_digits(spark):
    rows = spark.createDataFrame(
        [(record(), n, STAMP) for n in (7, 123456, 1234567)],
        "raw_record string, source_row_number long, ingestion_timestamp timestamp",
    )
    ids = {r["source_record_id"] for r in clean_visits(rows, heavy=[]).collect()}
    assert ids == {"2022-000007", "2022-123456", "2022-1234567"}


def test_repeated_visit_is_flagged_after_the_first(spark):
    rows = spark.createDataFrame(
        [(record(heart_rate="400"), 5, STAMP, o) for o in (30, 10, 20)] + [(record(), 6, STAMP, 40)],
        "raw_record string, source_row_number long, ingestion_timestamp timestamp, place long",
    )
    for heavy in ([], None):
        out = clean_visits(rows, "place", heavy)
        flags = sorted(tuple(r["data_quality_flags"]) for r in out.collect())
        assert flags == [(), ("INVALID_HEART_RATE",)] + [("INVALID_HEART_RATE", "DUPLICATE_VISIT_ID")] * 2
    report = quality_report(out, F.lit(STAMP)).first()
    assert (report["row_count"], report["duplicate_visit_ids"], report["invalid_vitals"], report["records_flagged"]) == (4, 2, 3, 3)
    assert (report["null_critical_fields"], report["invalid_triage"], report["records_rejected"]) == (0, 0, 0)
    assert report["flag_counts"] == {"DUPLICATE_VISIT_ID": 2, "FLAGGED": 3, "INVALID_HEART_RATE": 3, "VALID": 1}


def test_empty_table_reports_zero(spark):
    report = quality_report(clean_visits(bronze(spark, record()).filter("false"), heavy=[])).first()
    assert report["row_count"] == 0 and report["records_flagged"] == 0


def test_survey_text_takes_a_fraction_of_its_width_on_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "fresh_path", lambda _, name: str(tmp_path / name))
    monkeypatch.setattr(catalog, "_RECORDS_PER_FILE", 500, raising=False)
    folder = catalog._bronze_folder(spark, "/root/testdata/sf0.001")
    files = list((tmp_path / "survey").glob("part-*"))
    want = fixtures.records(spark, "/root/testdata/sf0.001").select("raw_record")
    rows = want.count()
    assert sum(f.stat().st_size for f in files) < rows * RECORD_WIDTH / 10
    got = read_bronze(spark, folder).cache()
    assert got.select("raw_record").exceptAll(want).isEmpty() and got.count() == rows
    # Several compressed files share a task; each one counts its own lines.
    per_file = got.groupBy("source_filename").agg(F.max("source_row_number"), F.count_distinct("source_row_number"), F.count("*"))
    counts = [tuple(r)[1:] for r in per_file.collect()]
    assert len(counts) == len(files) >= rows / 500 and all(a == b == c <= 500 for a, b, c in counts)
    got.unpersist()


def test_historical_run_stores_raw_records_small(spark, tmp_path):
    lines = [record(age=f"{i % 90:03}", patient_weight=f"{i * 7919 % 9973}.5") for i in range(4_000)]
    (tmp_path / "ed2022").write_text("\n".join(lines))
    done = historical.run(spark, str(tmp_path / "ed2022"), str(tmp_path / "out"), STAMP)
    assert sorted(r[0] for r in done["bronze_visits"].select("raw_record").collect()) == sorted(lines)
    stored = sum(f.stat().st_size for f in (tmp_path / "out" / "bronze_visits").rglob("part-*"))
    assert stored < len(lines) * RECORD_WIDTH / 50


def test_a_line_is_checked_once(spark, tmp_path):
    (tmp_path / "ed2022").write_text("plain\n\nmore\n")
    plan = read_bronze(spark, str(tmp_path / "ed2022"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("is_valid_utf8") + plan.count("isValid") <= 1


def test_raw_records_are_stored_in_line_order_without_a_sort(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for name, n in (("a", 300), ("b", 900), ("c", 600)):  # tasks read large files first
        (tmp_path / "in" / name).write_text("\n".join(record(age=f"{i % 90:03}") for i in range(n)))
    rows = read_bronze(spark, str(tmp_path / "in"), STAMP).coalesce(1)
    monkeypatch.setattr(type(rows), "sortWithinPartitions", lambda *_: pytest.fail("raw records are sorted"))
    sinks.write_laid_out(rows, str(tmp_path / "out"), "bronze_visits")
    stored = spark.read.parquet(str(tmp_path / "out")).coalesce(1).select("source_filename", "source_row_number").collect()
    assert stored == [(name, i + 1) for name, n in (("b", 900), ("c", 600), ("a", 300)) for i in range(n)]
    assert (tmp_path / "out" / "partition_date=2026-01-01").is_dir()


def test_ascii_check_does_not_count_characters(spark, tmp_path):
    (tmp_path / "ed2022").write_text("plain\n")
    plan = read_bronze(spark, str(tmp_path / "ed2022"))._jdf.queryExecution().optimizedPlan().toString()
    assert "char_length" not in plan and "length(value" not in plan.replace("octet_length(", "")


@pytest.mark.parametrize("bad", [bytes([b]) for b in (0x80, 0xBF, 0xC2, 0xE9, 0xF0, 0xFF)] + ["é".encode(), "€".encode(), "😀".encode()])
def test_any_byte_outside_ascii_fails_wherever_it_stands(spark, tmp_path, bad):
    path = tmp_path / "bad"
    for line in (bad + b"x" * 40, b"x" * 40 + bad, b"x" * 20 + bad + b"x" * 20):
        path.write_bytes(b"plain\n" + line + b"\n")
        with pytest.raises(Exception, match="not plain ASCII"):
            read_bronze(spark, str(path)).collect()
    path.write_bytes(bytes(b for b in range(128) if b not in (10, 13)) + b"\n")
    assert len(read_bronze(spark, str(path)).collect()) == 1


def test_numbers_and_codes_do_not_need_trimmed_fields(spark):
    blanks = " \t\x0b\x0c\x1c\x1d\x1e\x1f"
    rows = [record(age=f"{a}7{b}", waiting_time_minutes=f"{a}{b}8{a}", triage_level=f"{a}3", spo2=f"9{b}{a}") for a in blanks for b in blanks]
    rows += [record(sex=b, visit_weekday=b, admit_hospital=b, age=b * 3, pain_score=b * 2) for b in blanks]
    found = clean(spark, *rows)
    read = [tuple(r[c] for c in ("age", "waiting_time_minutes", "triage_level", "spo2")) for r in found[: len(blanks) ** 2]]
    assert set(read) == {(7, 8.0, 3, 9.0)}
    blank = [tuple(r[c] for c in ("sex", "visit_weekday", "admitted_flag", "disposition", "age", "pain_score")) for r in found[len(blanks) ** 2 :]]
    assert set(blank) == {(None, None, False, None, None, None)}
    plan = whole_plan(spark, clean_visits(bronze(spark, record()), heavy=[]))
    places = set(re.findall(r"trim\(cast\(substring\(cast\(raw_record#\d+ as binary\), (\d+), ", plan))
    texts = ("arrival_time", "reason_for_visit_code", "diagnosis_code", "patient_weight")
    assert places == {str(SURVEY_LAYOUT[name][0]) for name in texts}


def test_flags_and_constants_are_not_exchanged(spark):
    plan = whole_plan(spark, clean_visits(bronze(spark, record()), heavy=[]))
    below = plan[plan.index("Window [") :]
    assert "visit_id#" in below and not any(c in below for c in ("data_quality_flags", "source_system", "_key#", "diagnosis_description"))


def test_rows_without_a_key_repeat_each_other(spark):
    from edops.operators.quality import number_repeats

    rows = spark.createDataFrame([(None, 1), ("a", 2), (None, 3), ("", 4), ("a", 5)], "k string, o long")
    for heavy in ([], ["a"], ["\0"], None):
        out = {r["o"]: r["occurrence"] for r in number_repeats(rows, "k", "o", heavy).collect()}
        assert out == {1: 1, 2: 1, 3: 2, 4: 1, 5: 2}


def test_historical_run_leaves_no_shuffle_files_and_builds_cohorts_once(spark, tmp_path, monkeypatch):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {str(files.apply(i).getName()) for i in range(files.size()) if str(files.apply(i).getName()).startswith("shuffle_")}

    staged = []
    monkeypatch.setattr(historical, "stage", lambda df, name: staged.append(name) or stage(df, name))
    (tmp_path / "ed2022").write_text("\n".join(record(age=f"{i % 90:03}", triage_level="03") for i in range(500)))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old, before = spark.conf.get(setting), shuffles()
    historical.run(spark, str(tmp_path / "ed2022"), str(tmp_path / "out"), STAMP)
    assert staged == ["clean", "cohorts"] and spark.conf.get(setting) == old
    for _ in range(50):  # files are deleted in the background
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before


def test_flags_are_compiled_and_ids_sorted_by_a_number_first(spark):
    plan = clean_visits(bronze(spark, record()), heavy=[])._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
    window = next(line for line in plan.splitlines() if "Window [" in line)
    assert "], [_hash#" in window


def test_line_numbers_count_blank_lines_across_splits(spark, tmp_path):
    lines = [f"record {i} " + "x" * (i % 7) if i % 5 else "" for i in range(1, 400)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "ed2022").write_text("\n".join(lines) + "\n", encoding="ascii")
    (tmp_path / "in" / "other").write_text("\r\n".join(lines[:50]), encoding="ascii")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        out = read_bronze(spark, str(tmp_path / "in"), STAMP)
        assert out.rdd.getNumPartitions() > 5
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {(r["source_filename"], r["source_row_number"]): r["raw_record"] for r in rows}
    want = {("ed2022", i): t for i, t in enumerate(lines, 1) if t}
    want.update({("other", i): t for i, t in enumerate(lines[:50], 1) if t})
    assert got == want
    assert {r["ingestion_timestamp"] for r in rows} == {STAMP}
    assert (rows[0]["source_system"], rows[0]["source_year"]) == ("CDC_NHAMCS_ED", 2022)


@pytest.mark.parametrize("bad", ["café".encode(), "café".encode("latin-1"), b"x\x80y"])
def test_non_ascii_fails(spark, tmp_path, bad):
    path = tmp_path / "bad.txt"
    path.write_bytes(b"plain\n" + bad + b"\n")
    with pytest.raises(Exception, match="not plain ASCII"):
        read_bronze(spark, str(path)).collect()


def test_historical_run_and_write_protection(spark, tmp_path):
    (tmp_path / "ed2022").write_text("\n".join([record(age="030", triage_level="03"), "", record(spo2="120")]))
    done = historical.run(spark, str(tmp_path / "ed2022"), str(tmp_path / "out"), STAMP)
    metrics = done["run_metrics"].first()
    assert (metrics["records_processed"], metrics["records_flagged"], metrics["records_rejected"]) == (2, 1, 0)
    assert metrics["cohorts"] == done["historical_cohorts"].count()
    assert sorted(r["source_record_id"] for r in done["clean_ed_visits"].collect()) == ["2022-000001", "2022-000003"]
    assert (tmp_path / "out" / "clean_ed_visits" / "partition_date=2026-01-01").is_dir()
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        historical.run(spark, str(tmp_path / "ed2022"), str(tmp_path / "out"), STAMP)
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        write_table(done["dq_historical"], str(tmp_path / "out" / "dq_historical"))


def test_age_bands_and_diagnosis_group(spark):
    ages = [None, 0, 17, 18, 44, 45, 64, 65, 74, 75, 120]
    df = spark.createDataFrame([(a,) for a in ages], "age int").coalesce(1)
    assert [r[0] for r in df.select(age_band(F.col("age"))).collect()] == [
        "UNKNOWN", "0-17", "0-17", "18-44", "18-44", "45-64", "45-64", "65-74", "65-74", "75+", "75+",
    ]
    codes = spark.createDataFrame([("r509",), ("",), (None,)], "c string").coalesce(1)
    assert [r[0] for r in codes.select(diagnosis_group(F.col("c"))).collect()] == ["R", "UNKNOWN", "UNKNOWN"]
