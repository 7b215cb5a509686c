"""Run metrics of batch jobs and streaming queries."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

_SCHEMA = "component string, event string, records_processed long, records_rejected long, records_flagged long, cohorts long, duration_seconds double"


class BatchMetrics(StreamingQueryListener):
    """Appends one row per finished micro-batch to ``rows``."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seconds = float(p.batchDuration) / 1000 if p.batchDuration is not None else None
        self.rows.append((p.name, f"batch_{p.batchId}", p.numInputRows, None, None, None, seconds))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


@contextmanager
def timed():
    """Yields a function that gives the seconds since the start."""
    start = time.monotonic()
    yield lambda: time.monotonic() - start


def metrics_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, _SCHEMA)
