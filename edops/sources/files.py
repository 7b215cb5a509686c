"""File checks, fingerprints and plain readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


WHOLE_FILE = 1 << 30  # files up to this size are hashed as one value


def fingerprints(spark: SparkSession, path: str, suffix: str = "", whole: int = WHOLE_FILE) -> DataFrame:
    """Size and SHA-256 of each file.

    Files up to ``whole`` bytes are hashed by tasks, each as one binary value; a larger file
    cannot be one value and is streamed through a digest.
    """
    files = spark.read.format("binaryFile").load(path).filter(F.col("path").endswith(suffix))
    small = files.filter(F.col("length") <= whole).select(
        "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")
    )
    large = files.filter(F.col("length") > whole).select("path", "length").collect()
    if not large:
        return small
    rows = [(r["path"], r["length"], _streamed_sha256(spark, r["path"])) for r in large]
    return small.union(spark.createDataFrame(rows, "path string, size_bytes long, sha256 string"))


def _streamed_sha256(spark: SparkSession, path: str) -> str:
    """Digest of one file of any length; the JVM reads it in small blocks."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def verify_checksum(spark: SparkSession, path: str, expected_sha256: str) -> DataFrame:
    """Fingerprints of the files at ``path``; any other hash than expected is an error."""
    found = fingerprints(spark, path)
    same = F.lower("sha256") == expected_sha256.lower()
    failed = F.raise_error(
        F.concat(F.lit("Checksum mismatch: "), F.col("path"), F.lit(" has "), F.col("sha256"))
    )
    return found.withColumn("sha256", F.when(same, F.col("sha256")).otherwise(failed.cast("string")))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema; blank lines are ignored."""
    return spark.read.schema(schema).json(path)


def read_head(spark: SparkSession, path: str, n: int = 1000, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows of a published table, by ``order`` (by default all its sortable columns)."""
    rows = spark.read.parquet(path)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    order = order or [c for c, kind in kinds.items() if not kind.startswith("map") and kind != "variant"]
    return rows.orderBy(*order).limit(n)
