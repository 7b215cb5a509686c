"""Tables that are published together: versioned folders and one pointer, swapped last.

A release writes every table into a folder of its own, reads them back and compares rows and
content with what was written. Only then the pointer document is replaced, by one rename, so
readers see all tables of a release or all of the one before, and a release that fails
leaves the old one as it was.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from edops.operators.bi import assert_contract
from edops.sources import folders
from edops.sources.sinks import reconcile, require_reconciled, write_digested

POINTER = "current.json"


def publish_release(tables: dict[str, DataFrame], target: str, contract: bool = True) -> DataFrame:
    """Write, check and show a release; returns the reconciliation of its tables."""
    spark = next(iter(tables.values())).sparkSession
    name = f"{time.strftime('%Y%m%dT%H%M%SZ', time.gmtime())}-{uuid.uuid4().hex[:8]}"
    place = f"{target}/releases/{name}"
    written = {}
    for table, df in tables.items():
        if contract:
            assert_contract(df, table)
        written[table] = write_digested(df, f"{place}/{table}")
    checked = reconcile(spark, tables, place, written=written)
    require_reconciled(checked)
    listed = {table: {"rows": w.rows, "digest": list(map(str, w.digest))} for table, w in written.items()}
    folders.write_document(spark, f"{target}/{POINTER}", {"release": name, "tables": listed})
    return checked


def current_release(spark: SparkSession, target: str) -> dict:
    """The pointer: name of the release, and rows and digest of its tables."""
    found = folders.read_document(spark, f"{target}/{POINTER}")
    if found is None:
        raise FileNotFoundError(f"Nothing was released below {target}")
    return found


def read_release(spark: SparkSession, target: str, *tables: str) -> dict[str, DataFrame]:
    """Tables of the release that is shown now, all of one release; by default every table."""
    pointer = current_release(spark, target)
    wanted = tables or tuple(pointer["tables"])
    return {t: spark.read.parquet(f"{target}/releases/{pointer['release']}/{t}") for t in wanted}


def prune_releases(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete releases older than the newest ``keep`` and never the one shown; returns their names."""
    shown = current_release(spark, target)["release"]
    names = folders.children(spark, f"{target}/releases")
    old = [n for n in names[: max(0, len(names) - keep)] if n < shown]
    for name in old:
        folders.delete(spark, f"{target}/releases/{name}")
    return old
