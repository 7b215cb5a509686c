"""Compressed CSV extracts of three clinical tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from edops.schemas import CLINICAL_COLUMNS, DOCUMENT_TYPES, names, struct
from edops.session import stage
from edops.sources.files import fingerprints

SUFFIX = ".csv.gz"
_READ = {"multiLine": True, "nullValue": "", "encoding": "UTF-8", "escape": '"'}


def table_schema(document: str, header: list[str]) -> T.StructType:
    """Schema document (JSON text) to a Spark schema; names must equal ``header`` in order."""
    fields = json.loads(document)
    found = [field["name"] for field in fields]
    if found != list(header):
        raise ValueError(f"Schema and header differ: {found} against {list(header)}")
    return T.StructType(
        [
            T.StructField(f["name"], DOCUMENT_TYPES[f["type"]], f.get("mode", "NULLABLE") != "REQUIRED")
            for f in fields
        ]
    )


def read_extract(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed rows of one extract. Quoted line breaks stay, empty fields are NULL,
    a wrong header or an unreadable value fails the job."""
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, mode="FAILFAST", **_READ)
        .csv(path)
    )


def source_report(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Per file: size, SHA-256, header, row count and whether the header is right.

    One pass counts the records and keeps the first one of each file.
    """
    header = names(CLINICAL_COLUMNS[table])
    cells = [f"c{i}" for i in range(len(header) + 1)]  # one more shows a surplus column
    records = (
        spark.read.schema(", ".join(f"{c} string" for c in cells))
        .options(header=False, mode="PERMISSIVE", **_READ)
        .csv(path)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.monotonically_increasing_id().alias("position"),
            F.concat_ws(",", *cells).alias("line"),
        )
    )
    counted = records.groupBy("path").agg(
        F.min_by("line", "position").alias("header"), (F.count(F.lit(1)) - 1).alias("row_count")
    )
    files = fingerprints(spark, path, SUFFIX).withColumn("_name", _plain("path"))
    return (
        files.join(counted.withColumn("_name", _plain("path")).drop("path"), "_name", "left")
        .withColumn("table_name", F.lit(table))
        .withColumn("row_count", F.coalesce("row_count", F.lit(0)))
        .withColumn("header_ok", F.coalesce(F.col("header") == ",".join(header), F.lit(False)))
        .drop("_name")
    )


def _plain(column: str):
    """File paths are reported with one or three slashes after the scheme."""
    return F.regexp_replace(column, "^file:/+", "/")


def validate_source(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The stored source report, after checking that the extract can be loaded."""
    if not (path.endswith(SUFFIX) or _has_extract(spark, path)):
        raise ValueError(f"Expected {SUFFIX} files: {path}")
    report = stage(source_report(spark, path, table), "source-report")
    wrong = F.when(~F.col("header_ok"), F.struct("path", "header"))
    found = report.agg(
        F.count(F.lit(1)).alias("files"),
        F.min(wrong).alias("wrong"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
    ).first()
    if found["files"] == 0:
        raise FileNotFoundError(f"Missing required source file: {path}")
    if found["wrong"] is not None:
        raise ValueError(f"Unexpected header in {found['wrong']['path']}: {found['wrong']['header']}")
    if found["rows"] == 0:
        raise ValueError(f"Source file contains no data rows: {path}")
    return report


def _has_extract(spark: SparkSession, path: str) -> bool:
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(path)
    return not listing.select("path").isEmpty()


def clinical_schema(table: str) -> T.StructType:
    return struct(CLINICAL_COLUMNS[table])
