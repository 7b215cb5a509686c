from __future__ import annotations

import csv
import gzip
import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from edops.operators import bi
from edops.plans import clinical
from edops.plans.export import export
from edops.schemas import BI_TABLES, CLINICAL_COLUMNS, names
from edops.sources import releases, sinks
from edops.sources.clinical import clinical_schema, read_extract, source_report, table_schema, validate_source
from edops.sources.files import fingerprints, read_head, read_json_lines, verify_checksum

NOW = datetime(2026, 8, 24, 21, 7)
_GIVEN = {
    "edstays": {"subject_id": 51, "hadm_id": "", "stay_id": 907, "intime": "2121-06-03 23:10:00", "outtime": "2121-06-04 04:55:00",
                "gender": "M", "race": "UNKNOWN", "arrival_transport": "AMBULANCE", "disposition": "TRANSFER"},
    "triage": {"subject_id": 51, "stay_id": 907, "temperature": "101.2", "heartrate": 117, "resprate": 24, "o2sat": 93, "sbp": 104,
               "dbp": 58, "pain": "6", "acuity": 2, "chiefcomplaint": 'Cough; "wet", fever\nfor two days'},
    "vitalsign": {"subject_id": 51, "stay_id": 907, "charttime": "2121-06-04 01:20:00", "temperature": "100.4", "resprate": 22,
                  "o2sat": 95, "sbp": 109, "dbp": 60, "rhythm": "AF", "pain": "4"},
}
ROWS = {table: [row.get(c, "") for c in names(CLINICAL_COLUMNS[table])] for table, row in _GIVEN.items()}


def write_extracts(folder, headers=None, rows=ROWS):
    for table, ddl in CLINICAL_COLUMNS.items():
        with gzip.open(folder / f"{table}.csv.gz", "wt", encoding="utf-8", newline="") as stream:
            writer = csv.writer(stream)
            writer.writerow((headers or {}).get(table, names(ddl)))
            if rows:
                writer.writerow(rows[table])
    return str(folder)


def test_valid_extracts(spark, tmp_path):
    source = write_extracts(tmp_path)
    for table in CLINICAL_COLUMNS:
        path = f"{source}/{table}.csv.gz"
        row = validate_source(spark, path, table).first()
        content = (tmp_path / f"{table}.csv.gz").read_bytes()
        assert (row["row_count"], row["size_bytes"]) == (1, len(content))
        assert row["sha256"] == hashlib.sha256(content).hexdigest()
    triage = read_extract(spark, f"{source}/triage.csv.gz", clinical_schema("triage")).first()
    assert (triage["chiefcomplaint"], triage["temperature"], triage["acuity"]) == (_GIVEN["triage"]["chiefcomplaint"], 101.2, 2.0)
    vital = read_extract(spark, f"{source}/vitalsign.csv.gz", clinical_schema("vitalsign")).first()
    assert vital["heartrate"] is None and vital["charttime"] == datetime(2121, 6, 4, 1, 20)


@pytest.mark.parametrize("header", [["wrong", "header"], names(CLINICAL_COLUMNS["triage"]) + ["extra"], names(CLINICAL_COLUMNS["triage"])[::-1]])
def test_wrong_header_is_refused(spark, tmp_path, header):
    source = write_extracts(tmp_path, {"triage": header})
    with pytest.raises(ValueError, match="Unexpected header"):
        clinical.ingest(spark, source, str(tmp_path / "out"))


def test_missing_empty_and_broken_sources(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        validate_source(spark, str(tmp_path / "triage.csv.gz"), "triage")
    with pytest.raises(ValueError, match="Expected .csv.gz"):
        (tmp_path / "plain").mkdir()
        (tmp_path / "plain" / "triage.csv").write_text("x")
        validate_source(spark, str(tmp_path / "plain"), "triage")
    (tmp_path / "empty").mkdir()
    write_extracts(tmp_path / "empty", rows=None)
    with pytest.raises(ValueError, match="no data rows"):
        validate_source(spark, str(tmp_path / "empty" / "triage.csv.gz"), "triage")
    (tmp_path / "triage.csv.gz").write_bytes(b"this is not gzip")
    with pytest.raises(Exception, match="(?i)gzip|header"):
        validate_source(spark, str(tmp_path / "triage.csv.gz"), "triage")


def test_dry_run_writes_nothing_then_load_is_protected(spark, tmp_path):
    source = write_extracts(tmp_path)
    target = tmp_path / "bronze"
    plan = clinical.ingest(spark, source, str(target)).orderBy("position").collect()
    assert [(r["table_name"], r["row_count"], r["mode"]) for r in plan] == [(t, 1, "create only") for t in CLINICAL_COLUMNS]
    assert not target.exists()
    done = clinical.ingest(spark, source, str(target), apply=True).collect()
    assert all(r["matches"] and r["stored_rows"] == 1 for r in done)
    listed = spark.read.json(str(target / "manifest")).collect()
    assert sorted(r["table_name"] for r in listed) == sorted(CLINICAL_COLUMNS)
    assert all(r["applied"] and len(r["sha256"]) == 64 and r["row_count"] == 1 for r in listed)
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        clinical.ingest(spark, source, str(target), apply=True)
    clinical.ingest(spark, source, str(target), apply=True, replace=True)


def test_reconciliation_notices_a_difference(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(str(tmp_path / "t"))
    sinks.require_reconciled(sinks.reconcile(spark, {"t": df}, str(tmp_path)))
    with pytest.raises(ValueError, match="differ"):
        sinks.require_reconciled(sinks.reconcile(spark, {"t": spark.range(4)}, str(tmp_path)))


def test_reconciliation_notices_changed_content(spark, tmp_path):
    """Same rows and columns: one changed, moved or doubled cell makes ``matches`` false; order does not."""
    rows = [(1, "a", 0.5, None), (2, None, None, "x"), (2, None, None, "x"), (3, "c", -0.25, "")]
    schema = "n long, t string, d double, u string"
    df = spark.createDataFrame(rows, schema)
    written = sinks.write_digested(df, str(tmp_path / "a" / "t"))
    assert written.rows == 4
    again = sinks.write_digested(spark.createDataFrame(rows[::-1], schema).repartition(3), str(tmp_path / "b" / "t"))
    assert again == written
    assert sinks.reconcile(spark, {"t": df}, str(tmp_path / "b")).first()["matches"]
    changes = [
        [(1, "a", 0.5, None), (2, None, None, "x"), (2, None, None, "y"), (3, "c", -0.25, "")],
        [(1, "a", 0.5, None), (2, "x", None, None), (2, None, None, "x"), (3, "c", -0.25, "")],
        [(1, "a", 0.5, None), (1, "a", 0.5, None), (2, None, None, "x"), (3, "c", -0.25, "")],
        [(1, "a", 0.5, ""), (2, None, None, "x"), (2, None, None, "x"), (3, "c", -0.25, None)],
    ]
    for i, changed in enumerate(changes):
        spark.createDataFrame(changed, schema).write.parquet(str(tmp_path / f"c{i}" / "t"))
        for known in (None, {"t": written}):
            checked = sinks.reconcile(spark, {"t": df}, str(tmp_path / f"c{i}"), written=known).first()
            assert checked["row_count"] == checked["stored_rows"] == 4 and not checked["matches"]


def broken(spark, df):
    """A table whose write fails after some rows."""
    n = df.columns[0]
    return df.withColumn(n, F.when(F.rand() < 2, F.raise_error(F.lit("disk full")).cast(df.schema[n].dataType)))


def test_a_failing_write_leaves_the_old_folder(spark, tmp_path):
    old = spark.createDataFrame([(1, "a")], "n long, t string")
    for write in (lambda df, p: sinks.write_table(df, p, replace=True), sinks.write_document, sinks.write_csv, lambda df, p: sinks.write_digested(df, p, True)):
        path = tmp_path / f"t{len(list(tmp_path.iterdir()))}" / "out"
        write(old, str(path))
        before = sorted((f.name, f.read_bytes()) for f in path.iterdir())
        with pytest.raises(Exception, match="disk full"):
            write(broken(spark, old), str(path))
        assert sorted((f.name, f.read_bytes()) for f in path.iterdir()) == before
        assert [f.name for f in path.parent.iterdir()] == ["out"]  # nothing is left aside
        write(old.union(old), str(path))
        assert sorted((f.name, f.read_bytes()) for f in path.iterdir()) != before


def test_five_tables_change_together(spark, tmp_path):
    """A release whose fourth table fails leaves the five tables of the one before."""
    target = str(tmp_path / "gold")
    with pytest.raises(FileNotFoundError):
        releases.read_release(spark, target)
    first = tables(spark)
    assert all(r["matches"] for r in releases.publish_release(first, target).collect())
    name = releases.current_release(spark, target)["release"]
    rows = {t: sorted(map(str, df.collect())) for t, df in releases.read_release(spark, target).items()}
    assert rows == {t: sorted(map(str, df.collect())) for t, df in first.items()}
    fourth = list(first)[3]
    with pytest.raises(Exception, match="disk full"):
        releases.publish_release(first | {fourth: broken(spark, first[fourth])}, target, contract=False)
    assert releases.current_release(spark, target)["release"] == name
    assert {t: sorted(map(str, df.collect())) for t, df in releases.read_release(spark, target).items()} == rows
    more = {t: df.union(df) for t, df in first.items()}
    releases.publish_release(more, target)
    shown = releases.read_release(spark, target, "ed_kpis", fourth)
    assert all(df.count() == 2 * first[t].count() for t, df in shown.items())
    kept = releases.prune_releases(spark, target, keep=1)
    assert name in kept and shown[fourth].count() == 2 * first[fourth].count()


def test_schema_document_and_versioned_path():
    fields = [{"name": "a", "type": "INTEGER", "mode": "NULLABLE"}, {"name": "b", "type": "TIMESTAMP"}]
    assert table_schema(json.dumps(fields), ["a", "b"]).simpleString() == "struct<a:bigint,b:timestamp>"
    with pytest.raises(ValueError, match="differ"):
        table_schema(json.dumps(fields), ["b", "a"])
    assert clinical.raw_path("s3://raw", "2.2", "edstays") == "s3://raw/mimic-iv-ed/2.2/ed/edstays.csv.gz"


def test_surplus_column_shows_in_report(spark, tmp_path):
    source = write_extracts(tmp_path, {"edstays": names(CLINICAL_COLUMNS["edstays"]) + ["more"]})
    assert source_report(spark, f"{source}/edstays.csv.gz", "edstays").first()["header_ok"] is False


def tables(spark):
    values = {"timestamp": NOW, "long": 3, "int": 2, "double": 1.5, "string": "text, more"}
    out = {}
    for name, ddl in BI_TABLES.items():
        row = tuple(values[c.split()[1]] for c in ddl.split(", "))
        out[name] = spark.createDataFrame([row, row], ddl)
    return out


def test_contracts_are_flat_and_checked(spark):
    for name, df in tables(spark).items():
        bi.assert_contract(df, name)
        with pytest.raises(ValueError, match="contract"):
            bi.assert_contract(df.select(*reversed(df.columns)), name)
    with pytest.raises(ValueError, match="Nested"):
        bi.assert_flat(spark.range(1).select(F.array("id").alias("a")))
    assert list(BI_TABLES) == ["ed_kpis", "ed_load_15min", "active_patients", "historical_context", "data_quality"]


def test_csv_round_trip_and_validation(spark, tmp_path):
    listed, checked = export(spark, tables(spark), str(tmp_path))
    assert {r["status"] for r in checked.collect()} == {"PASS"}
    for name, ddl in BI_TABLES.items():
        files = list((tmp_path / name).glob("*.csv"))
        rows = [row for f in files for row in csv.reader(f.open(newline=""))]
        assert rows.count(names(ddl)) == len(files) and len(rows) == 2 + len(files)
    assert [r["table_name"] for r in listed.orderBy("position").collect()] == list(BI_TABLES)
    assert spark.read.json(str(tmp_path / "manifest")).count() == 5


def test_validation_finds_secrets_and_lost_rows(spark, tmp_path):
    data = tables(spark)
    data["data_quality"] = data["data_quality"].withColumn("description", F.lit("Token=abc"))
    listed, checked = export(spark, data, str(tmp_path))
    status = {r["table_name"]: (r["status"], r["secret_rows"]) for r in checked.collect()}
    assert status["data_quality"] == ("FAIL", 2) and status["ed_kpis"] == ("PASS", 0)
    more = listed.withColumn("row_count", F.col("row_count") + 1)
    assert {r["status"] for r in sinks.validate_export(spark, more, str(tmp_path)).collect()} == {"FAIL"}
    wrong = listed.withColumn("columns", F.lit("a,b"))
    with pytest.raises(ValueError, match="Column mismatch"):
        sinks.validate_export(spark, wrong, str(tmp_path))


def test_empty_export_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        sinks.write_csv(spark.range(0), str(tmp_path / "t"))


def test_publish_plan_then_load(spark, tmp_path):
    target = str(tmp_path / "gold")
    plan = sinks.publish(tables(spark), target)
    assert [r["mode"] for r in plan.collect()] == ["replace"] * 5 and not (tmp_path / "gold").exists()
    for _ in range(2):  # replace loads can be repeated
        assert all(r["matches"] for r in sinks.publish(tables(spark), target, apply=True).collect())
    assert read_head(spark, f"{target}/ed_kpis", 1).count() == 1


def test_publish_to_the_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE gold_test LOCATION '{tmp_path}/gold_test'")
    try:
        for _ in range(2):
            done = sinks.publish(tables(spark), "gold_test", apply=True, catalog=True)
            assert all(r["matches"] for r in done.collect())
        with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
            sinks.publish(tables(spark), "gold_test", apply=True, replace=False, catalog=True)
    finally:
        spark.sql("DROP DATABASE gold_test CASCADE")


def test_status_of_checks(spark):
    df = spark.createDataFrame([(0, "HARD"), (1, "HARD"), (0, "SOFT"), (2, "SOFT"), (5, "INFO")], "n long, k string").coalesce(1)
    got = [r[0] for r in df.select(bi.check_status(F.col("n"), F.col("k"))).collect()]
    assert got == ["PASS", "FAIL", "PASS", "WARN", "PASS"]


def test_active_patient_defaults(spark):
    row = spark.createDataFrame(
        [("V", None, None, ["A", "B"], "K")],
        "visit_id string, attention_level string, current_status string, attention_reason array<string>, historical_cohort_key string",
    )
    got = bi.bi_active_patients(row).first()
    assert (got["attention_level"], got["current_status"], got["attention_reason"], got["historical_cohort"]) == ("LOW", "UNKNOWN", "A; B", "K")
    assert got["wait_ratio"] is None


def test_files(spark, tmp_path):
    (tmp_path / "rows.jsonl").write_text('{"a":1}\n\n   \n{"a":2}\n')
    assert sorted(r["a"] for r in read_json_lines(spark, str(tmp_path / "rows.jsonl"), "a int").collect()) == [1, 2]
    digest = hashlib.sha256((tmp_path / "rows.jsonl").read_bytes()).hexdigest()
    assert verify_checksum(spark, str(tmp_path / "rows.jsonl"), digest.upper()).first()["sha256"] == digest
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "small.bin").write_bytes(b"ab")
    (tmp_path / "two" / "large.bin").write_bytes(b"x" * 50_000)
    found = {r["size_bytes"]: r["sha256"] for r in fingerprints(spark, str(tmp_path / "two"), whole=10).collect()}
    assert found == {n: hashlib.sha256(c * (n // len(c))).hexdigest() for n, c in ((2, b"ab"), (50_000, b"x"))}
    with pytest.raises(Exception, match="Checksum mismatch"):
        verify_checksum(spark, str(tmp_path / "rows.jsonl"), "0" * 64).collect()
    assert sinks.write_counted(spark.range(7), str(tmp_path / "n")) == 7


def test_every_filter_column_reads_few_files(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.pmod(F.xxhash64("id"), F.lit(6)).cast("int").alias("triage_level"),
        F.concat(F.lit("disposition_"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).cast("string")).alias("disposition"),
        F.when(F.col("id") % 3 > 0, "VALID").alias("data_quality_status"),
        F.timestamp_seconds(F.lit(1_770_000_000)).alias("ingestion_timestamp"),
        "id",
    )
    path = str(tmp_path / "clustered")
    sinks.write_laid_out(rows, path, "clean_ed_visits", files=32)
    read = spark.read.parquet(path)
    assert read.count() == 20_000 and read.select("id").distinct().count() == 20_000
    of_file = read.groupBy(F.input_file_name().alias("f"))
    disposition = of_file.agg(F.min("disposition").alias("lo"), F.max("disposition").alias("hi"), F.count(F.lit(1)).alias("n")).collect()
    triage = of_file.agg(F.min("triage_level").alias("lo"), F.max("triage_level").alias("hi")).collect()
    assert len(disposition) == 32 and max(r["n"] for r in disposition) < 3 * 20_000 / 32
    for found, value in ((disposition, "disposition_7"), (triage, 2)):
        assert sum(r["lo"] <= value <= r["hi"] for r in found) <= 16
    # One value everywhere is still cut into files of like size.
    flat = rows.withColumns({"triage_level": F.lit(1), "disposition": F.lit("x"), "data_quality_status": F.lit(None).cast("string")})
    sinks.write_laid_out(flat, str(tmp_path / "flat"), "clean_ed_visits", files=8)
    sizes = spark.read.parquet(str(tmp_path / "flat")).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 5_000
    sinks.write_laid_out(flat.limit(0), str(tmp_path / "none"), "clean_ed_visits")
    assert spark.read.schema(flat.schema).parquet(str(tmp_path / "none")).isEmpty()


def test_check_table_reads_a_stored_report(spark):
    from edops.plans import catalog

    report, streaming = catalog._reports(spark, "/root/testdata/sf0.001")
    plan = bi.bi_data_quality(report, streaming)._jdf.queryExecution().optimizedPlan().toString()
    assert "_before" not in report._jdf.queryExecution().optimizedPlan().toString() and "l_orderkey" not in plan
