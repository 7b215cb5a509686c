"""Fixed-width survey file to Bronze rows with physical line numbers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from edops.functions.times import utc_literal
from edops.schemas import BRONZE_VISITS, SOURCE_SYSTEM, SOURCE_YEAR, names
from edops.session import stage


BROADCAST_ROWS = 500_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as (path, filename, line_number, value).

    A file split is read by one task in order, so a row's place in its split plus the
    lines of the earlier splits of its file gives the line number. A first pass counts
    the lines of each split (one row per split); the lines themselves are not moved.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
        "value",
    )
    splits = lines.groupBy("path", "block").agg(
        F.min("position").alias("first"), F.count(F.lit(1)).alias("n")
    )
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        splits.select(
            "path",
            "block",
            "first",
            "n",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        ),
        "splits",
    )
    # One row per 128 MB of text or compressed file; beyond the limit the join exchanges rows instead.
    few = offsets.count() <= BROADCAST_ROWS
    joined = lines.join(F.broadcast(offsets) if few else offsets, ["path", "block"], "left")
    place = F.col("position") - F.col("first")
    # Were the file cut differently by the second pass, some row of a shifted split
    # would fall outside its range: the job then fails instead of numbering wrongly.
    same_cut = F.coalesce((place >= 0) & (place < F.col("n")), F.lit(False))
    number = F.when(same_cut, F.col("offset") + place + 1).otherwise(
        F.raise_error(F.lit("File splits changed between two passes; run again")).cast("long")
    )
    return joined.select("path", "filename", number.alias("line_number"), "value")


def ascii_only(text: Column) -> Column:
    """The text, or an error when it holds any byte outside ASCII.

    Read as Latin-1, every byte is one character, and written as UTF-8 again only bytes outside
    ASCII take two. The JVM does both for many bytes at once; counting characters or looking
    for an invalid byte goes byte by byte and takes several times as long.
    """
    widened = F.decode(text.cast("binary"), "ISO-8859-1")
    clean = F.octet_length(widened) == F.octet_length(text)
    return F.when(clean, text).otherwise(
        F.raise_error(F.lit("Source record is not plain ASCII")).cast("string")
    )


def read_bronze(
    spark: SparkSession,
    path: str,
    ingested_at: datetime | None = None,
    source_system: str = SOURCE_SYSTEM,
    source_year: int = SOURCE_YEAR,
) -> DataFrame:
    """Raw records with their origin. Blank lines are counted, then left out."""
    stamp = utc_literal(ingested_at) if ingested_at else F.current_timestamp()
    # Told blank by the text as read, so that a line is checked once and not for the filter as well.
    return (
        numbered_lines(spark, path)
        .filter(F.col("value") != "")
        .select(
            ascii_only(F.col("value")).alias("raw_record"),
            F.lit(source_system).alias("source_system"),
            F.lit(source_year).cast("int").alias("source_year"),
            F.col("filename").alias("source_filename"),
            F.col("line_number").alias("source_row_number"),
            stamp.alias("ingestion_timestamp"),
        )
        .select(*names(BRONZE_VISITS))
    )
