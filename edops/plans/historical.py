"""Historical batch: survey file to Bronze, clean visits, quality report and cohorts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from edops.operators.cohorts import build_cohorts
from edops.operators.quality import quality_report
from edops.operators.survey import clean_visits
from edops.session import stage, transient_shuffles
from edops.sources.fixed_width import read_bronze
from edops.sources.sinks import write_laid_out
from edops.streaming.metrics import metrics_table, timed


def silver(bronze: DataFrame, order: str = "source_row_number") -> DataFrame:
    return clean_visits(bronze, order)


def run(
    spark: SparkSession, source: str, target: str, ingested_at: datetime | None = None, replace: bool = False
) -> dict[str, DataFrame]:
    """Run every layer from stored tables and return them, with a metrics row."""
    with timed() as elapsed, transient_shuffles(spark):
        bronze = _store(read_bronze(spark, source, ingested_at), target, "bronze_visits", replace)
        visits = _store(stage(clean_visits(bronze), "clean"), target, "clean_ed_visits", replace)
        report = _store(quality_report(visits), target, "dq_historical", replace)
        cohorts = _store(stage(build_cohorts(visits), "cohorts"), target, "historical_cohorts", replace)
        totals = report.first()
        row = (
            "historical",
            "completed",
            totals["row_count"],
            totals["records_rejected"],
            totals["records_flagged"],
            cohorts.count(),
            elapsed(),
        )
    return {
        "bronze_visits": bronze,
        "clean_ed_visits": visits,
        "dq_historical": report,
        "historical_cohorts": cohorts,
        "run_metrics": metrics_table(spark, [row]),
    }


def _store(df: DataFrame, target: str, table: str, replace: bool) -> DataFrame:
    path = f"{target}/{table}"
    if table == "dq_historical":
        df.coalesce(1).write.mode("overwrite" if replace else "errorifexists").parquet(path)
    else:
        write_laid_out(df, path, table, replace)
    return df.sparkSession.read.parquet(path).select(*[F.col(c) for c in df.columns])
