"""Folders of the shared file system: listing, small documents, and tables that appear whole."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def _place(spark: SparkSession, path: str):
    """File system and path object, as Spark resolves them."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _place(spark, path)
    return system.exists(at)


def create(spark: SparkSession, path: str) -> None:
    system, at = _place(spark, path)
    system.mkdirs(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder, hidden ones left out; none if it is not there."""
    system, at = _place(spark, path)
    if not system.exists(at):
        return []
    names = [status.getPath().getName() for status in system.listStatus(at)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def write_document(spark: SparkSession, path: str, value: object) -> None:
    """Put a small JSON document in place of the one before, by one rename."""
    system, at = _place(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/_aside-{uuid.uuid4().hex}")
    stream = system.create(aside)
    try:
        stream.write(bytearray(json.dumps(value).encode()))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(context.makeQualified(aside), context.makeQualified(at), overwrite)


def read_document(spark: SparkSession, path: str) -> object | None:
    """The document at ``path``; None if there is none."""
    system, at = _place(spark, path)
    if not system.exists(at):
        return None
    stream = system.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to a name that is free."""
    system, at = _place(spark, source)
    _, to = _place(spark, target)
    system.mkdirs(to.getParent())
    if system.exists(to) or not system.rename(at, to):
        raise FileExistsError(f"Cannot move {source} to {target}")


def write_whole(df: DataFrame, path: str) -> None:
    """Write Parquet aside and rename the folder, so that readers see all of it or nothing."""
    aside = aside_of(path)
    df.write.mode("errorifexists").parquet(aside)
    rename(df.sparkSession, aside, path)


def delete(spark: SparkSession, path: str) -> None:
    system, at = _place(spark, path)
    system.delete(at, True)


def replace_whole(spark: SparkSession, aside: str, path: str) -> None:
    """Put a folder that is written whole in the place of another one.

    The old folder is moved away first and comes back if the new one cannot be moved in.
    """
    if not exists(spark, path):
        rename(spark, aside, path)
        return
    parent, name = path.rstrip("/").rsplit("/", 1)
    old = f"{parent}/_old-{name}-{uuid.uuid4().hex}"
    rename(spark, path, old)
    try:
        rename(spark, aside, path)
    except Exception:
        rename(spark, old, path)
        raise
    delete(spark, old)


def aside_of(path: str) -> str:
    """A hidden folder next to ``path``, for what is to replace it."""
    parent, name = path.rstrip("/").rsplit("/", 1)
    return f"{parent}/_aside-{name}-{uuid.uuid4().hex}"
