"""Five flat tables for BI, their manifest and their checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from edops.schemas import BI_TABLES, DQ_CHECKS, SECRET_MARKERS, names, struct


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of a published table in contract order and type; absent ones are NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct(BI_TABLES[table])
        ]
    )


def bi_kpis(snapshot: DataFrame, enriched: DataFrame) -> DataFrame:
    critical = enriched.agg(
        F.count_if(F.col("attention_level") == "CRITICAL").cast("long")
    ).scalar()
    renamed = snapshot.withColumnsRenamed(
        {"as_of": "snapshot_time", "patients_above_expected_wait": "patients_above_expected"}
    )
    return conform(renamed.withColumn("critical_attention_patients", critical), "ed_kpis")


def bi_load_15min(load: DataFrame) -> DataFrame:
    return conform(load, "ed_load_15min")


def bi_active_patients(enriched: DataFrame) -> DataFrame:
    """Flat visit rows: joined reasons, upper-cased labels with defaults."""
    flat = enriched.withColumns(
        {
            "attention_reason": F.concat_ws("; ", "attention_reason"),
            "historical_cohort": F.col("historical_cohort_key"),
            "attention_level": F.upper(F.coalesce("attention_level", F.lit("LOW"))),
            "current_status": F.upper(F.coalesce("current_status", F.lit("UNKNOWN"))),
        }
    )
    return conform(flat, "active_patients")


def bi_historical_context(cohorts: DataFrame) -> DataFrame:
    return conform(cohorts, "historical_context")


def check_status(count: Column, kind: Column) -> Column:
    """0 passes; above 0 soft checks warn and hard checks fail. INFO always passes."""
    return (
        F.when((count == 0) | (kind == "INFO"), "PASS").when(kind == "SOFT", "WARN").otherwise("FAIL")
    )


def _unpivot(report: DataFrame, source: str) -> DataFrame:
    counters = [(check, counter) for check, src, counter, _, _ in DQ_CHECKS if src == source]
    rows = F.array(
        *[
            F.struct(F.lit(check).alias("check_name"), F.col(counter).alias("record_count"))
            for check, counter in counters
        ]
    )
    return report.select(F.inline(rows))


def dq_catalog(spark: SparkSession) -> DataFrame:
    rows = [(check, kind, text) for check, _, _, kind, text in DQ_CHECKS]
    return spark.createDataFrame(rows, "check_name string, kind string, description string")


def bi_data_quality(historical: DataFrame, streaming: DataFrame) -> DataFrame:
    """One row per catalogued check, from the two one-row quality reports."""
    counts = _unpivot(historical, "historical").unionByName(_unpivot(streaming, "streaming"))
    stamp = historical.select("generated_at").scalar()
    checks = counts.join(F.broadcast(dq_catalog(counts.sparkSession)), "check_name")
    return conform(
        checks.withColumn("status", check_status(F.col("record_count"), F.col("kind"))).withColumn(
            "generated_at", stamp
        ),
        "data_quality",
    )


def assert_flat(df: DataFrame) -> None:
    """Published tables hold no arrays, structs or maps."""
    nested = [
        f.name for f in df.schema if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
    ]
    if nested:
        raise ValueError(f"Nested columns are not allowed: {nested}")


def assert_contract(df: DataFrame, table: str) -> None:
    """Column names, order and types must equal the published contract."""
    wanted = [(f.name, f.dataType) for f in struct(BI_TABLES[table])]
    found = [(f.name, f.dataType) for f in df.schema]
    if found != wanted:
        raise ValueError(f"{table} does not match its contract: {found}")
    assert_flat(df)


def manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """Order, name, columns and row count of each table."""
    parts = [
        df.agg(
            F.lit(i).alias("position"),
            F.lit(name).alias("table_name"),
            F.lit(",".join(df.columns)).alias("columns"),
            F.count(F.lit(1)).alias("row_count"),
        )
        for i, (name, df) in enumerate(tables.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def secret_rows(df: DataFrame, markers: list[str] = SECRET_MARKERS) -> Column:
    """Number of rows whose text holds a secret marker."""
    text = F.lower(F.concat_ws("\n", *[F.col(c).cast("string") for c in df.columns]))
    hit = reduce(lambda a, b: a | b, [text.contains(m) for m in markers])
    return F.count_if(hit)


# --- Report views -------------------------------------------------------------


def attention_order(level: Column) -> Column:
    out = F.lit(0)
    for i, label in enumerate(["LOW", "MEDIUM", "HIGH", "CRITICAL"], start=1):
        out = F.when(level == label, i).otherwise(out)
    return out


def wait_variance_category(variance: Column, ratio: Column) -> Column:
    return (
        F.when(variance <= 0, "At or below expected")
        .when(ratio >= 2, "At least 2x expected")
        .otherwise("Above expected")
    )


def attention_distribution(active: DataFrame) -> DataFrame:
    return (
        active.groupBy("attention_level")
        .agg(F.count(F.lit(1)).alias("visits"))
        .withColumn("sort_order", attention_order(F.col("attention_level")))
    )


def match_level_distribution(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("historical_match_level").agg(F.count(F.lit(1)).alias("visits"))


def wait_vs_history(active: DataFrame) -> DataFrame:
    return active.select(
        "visit_id", "waiting_minutes", "expected_wait_minutes", "historical_p90_wait_minutes"
    )


def queue(
    active: DataFrame,
    triage_levels: list[int] | None = None,
    attention_levels: list[str] | None = None,
    statuses: list[str] | None = None,
) -> DataFrame:
    """Operational queue with the three dashboard filters."""
    filters = {
        "triage_level": triage_levels,
        "attention_level": attention_levels,
        "current_status": statuses,
    }
    for column, values in filters.items():
        if values is not None:
            active = active.filter(F.col(column).isin(values))
    return active


def queue_order() -> list[Column]:
    return [F.desc("attention_score"), F.desc("waiting_minutes"), F.asc("visit_id")]


def top_of_queue(active: DataFrame, n: int) -> DataFrame:
    """The ``n`` most urgent visits (the report itself is a top list)."""
    return active.orderBy(*queue_order()).limit(n)


def distinct_visits(active: DataFrame) -> DataFrame:
    return active.agg(
        F.countDistinct("visit_id").alias("visits"), F.countDistinct("patient_id").alias("patients")
    )


def load_rollup(load: DataFrame, by: Column, name: str) -> DataFrame:
    """Snapshot metrics take the maximum, flow metrics the sum."""
    return load.groupBy(by.alias(name)).agg(
        F.max("active_patients").alias("active_patients"),
        F.sum("new_arrivals").alias("new_arrivals"),
        F.sum("admissions").alias("admissions"),
        F.sum("discharges").alias("discharges"),
        F.max("avg_wait_minutes").alias("avg_wait_minutes"),
        F.max("high_attention_count").alias("high_attention_count"),
    )


def table_columns() -> dict[str, list[str]]:
    return {table: names(ddl) for table, ddl in BI_TABLES.items()}
