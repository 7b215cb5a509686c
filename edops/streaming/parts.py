"""Tables cut into parts: a write replaces only the parts that it touches.

Every version writes its parts below a folder of its own and then one small manifest, which
names for each part the version that holds it. Readers open only folders that
the manifest of a version names, so a version without its manifest has not happened, older
versions stay readable, and a part that no write touches is never read or written again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from edops.sources import folders


def read_or_empty(spark: SparkSession, schema: str, path: str | None) -> DataFrame:
    """The table at ``path``; a folder that was never written is an empty table."""
    if path is not None:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def spread(rows: DataFrame, part: str, parts: int) -> DataFrame:
    """Rows dealt by their part to as many tasks as there are parts, or shuffle partitions if fewer.

    Rows without a part are dealt evenly.
    """
    tasks = min(parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, F.coalesce(F.col(part).cast("long"), F.monotonically_increasing_id()))


@dataclass
class PartTable:
    """A table of ``schema`` whose parts are the values of the column ``part``.

    ``place`` gives the folder of a version's parts; they lie there as ``part=value``.
    """

    spark: SparkSession
    manifests: str
    schema: str
    part: str
    place: Callable[[int], str]

    def _manifest(self, version: int) -> str:
        return f"{self.manifests}/version={version}.json"

    def live(self, version: int | None) -> dict[str, int]:
        """The version that holds each part after a version."""
        if version is None or version < 0:
            return {}
        return folders.read_document(self.spark, self._manifest(version)) or {}

    def newest(self) -> int | None:
        """Newest complete version; None before the first."""
        names = folders.children(self.spark, self.manifests)
        return max((int(n.removeprefix("version=").removesuffix(".json")) for n in names), default=None)

    def paths(self, version: int | None, parts: Iterable[object] | None = None) -> list[str]:
        """Folders that hold the rows after a version, of all parts or of the named ones."""
        live = self.live(version)
        chosen = live if parts is None else [p for p in map(str, parts) if p in live]
        return [f"{self.place(live[p])}/{self.part}={p}" for p in sorted(chosen)]

    def read(self, version: int | None, parts: Iterable[object] | None = None) -> DataFrame:
        """Rows after a version, of all parts or of the named ones; other folders are not opened."""
        paths = self.paths(version, parts)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, rows: DataFrame, version: int, touched: Iterable[object], before: int | None) -> None:
        """Replace the touched parts by ``rows``, which hold the part's column as well."""
        rows.hint("rebalance", self.part).write.mode("overwrite").partitionBy(self.part).parquet(self.place(version))
        self.commit(version, touched, before)

    def commit(self, version: int, touched: Iterable[object], before: int | None) -> None:
        """Make the written parts of a version live; a touched part without rows is gone."""
        live = self.live(before)
        for part in map(str, touched):
            live.pop(part, None)
        for name in folders.children(self.spark, self.place(version)):
            live[name.partition("=")[2]] = version
        folders.write_document(self.spark, self._manifest(version), live)
