"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Generated methods above 8,000 bytes are never compiled by the JVM; wide projections
    # then run faster with one generated class per operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # JSON objects with a repeated key keep the last value instead of failing to parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings every operator relies on (all changeable at run time)."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def transient_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query go when it ends, not when the driver collects its garbage.

    For jobs whose every step ends in a stored table, so that nothing is exchanged again.
    """
    before = spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)


def shared_root(spark: SparkSession) -> str:
    """Folder for staged tables: the cluster's checkpoint folder.

    Only a local session without that setting gets a folder of its own.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/edops"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="edops-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    The written table cuts the lineage, survives lost executors, and lets every
    consumer read only the columns it needs.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_if(needed: bool, df: DataFrame, name: str) -> DataFrame:
    """Stage a result that several branches are about to read; otherwise leave it lazy."""
    return stage(df, name) if needed else df
