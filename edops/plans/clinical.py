"""Clinical CSV extracts to Bronze tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from edops.schemas import CLINICAL_COLUMNS
from edops.session import stage
from edops.sources.clinical import SUFFIX, clinical_schema, read_extract, validate_source
from edops.sources.sinks import load_plan, reconcile, require_reconciled, write_digested, write_rows


def source_path(source_dir: str, table: str) -> str:
    return f"{source_dir}/{table}{SUFFIX}"


def raw_path(root: str, version: str, table: str) -> str:
    """Versioned place of the unchanged extract."""
    return f"{root}/mimic-iv-ed/{version}/ed/{table}{SUFFIX}"


def ingest(
    spark: SparkSession,
    source_dir: str,
    target: str,
    schemas: dict[str, T.StructType] | None = None,
    apply: bool = False,
    replace: bool = False,
) -> DataFrame:
    """Validate all extracts; then return the plan, or load and reconcile each table.

    An extract is read for its report (rows, header, hash) and once more to be stored; plan,
    reconciliation and manifest take its counts from the stored report.
    """
    tables = list(CLINICAL_COLUMNS)
    reports = [validate_source(spark, source_path(source_dir, t), t) for t in tables]
    schemas = schemas or {t: clinical_schema(t) for t in tables}
    sources = {t: read_extract(spark, source_path(source_dir, t), schemas[t]) for t in tables}
    counted = reduce(
        DataFrame.unionByName,
        [
            report.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")).select(
                F.lit(i).alias("position"),
                F.lit(t).alias("table_name"),
                F.lit(",".join(sources[t].columns)).alias("columns"),
                "row_count",
            )
            for i, (t, report) in enumerate(zip(tables, reports))
        ],
    )
    if not apply:
        return load_plan(sources, target, replace, counted)
    written = {}
    for name, df in sources.items():
        # One compressed file is one task; its rows are spread before they are stored.
        written[name] = write_digested(df.hint("rebalance"), f"{target}/{name}", replace)
    checked = stage(reconcile(spark, sources, target, counted=counted, written=written), "reconciled")
    require_reconciled(checked)
    write_rows(run_manifest(reports, target, apply), f"{target}/manifest")
    return checked


def run_manifest(reports: list[DataFrame], target: str, applied: bool) -> DataFrame:
    """One row per source file: its fingerprint, the target and the mode of the run."""
    files = reduce(DataFrame.unionByName, reports)
    return files.select(
        F.lit(target).alias("target"),
        F.lit(applied).alias("applied"),
        "table_name",
        "path",
        "size_bytes",
        "sha256",
        "row_count",
    )
