"""BI export and publishing of the five tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edops.operators import bi
from edops.plans.replay import Gold
from edops.session import stage
from edops.sources.sinks import validate_export, write_csv, write_document


def bi_tables(
    gold: Gold, cohorts: DataFrame, historical_report: DataFrame, streaming_report: DataFrame
) -> dict[str, DataFrame]:
    """The published tables in their fixed order."""
    return {
        "ed_kpis": bi.bi_kpis(gold.ed_kpis, gold.current_ed_state),
        "ed_load_15min": bi.bi_load_15min(gold.ed_load_15min),
        "active_patients": bi.bi_active_patients(gold.current_ed_state),
        "historical_context": bi.bi_historical_context(cohorts),
        "data_quality": bi.bi_data_quality(historical_report, streaming_report),
    }


def export(
    spark: SparkSession, tables: dict[str, DataFrame], folder: str
) -> tuple[DataFrame, DataFrame]:
    """Write the CSVs and the manifest, then validate what was written."""
    stored = {name: stage(df, name) for name, df in tables.items()}
    order = {
        "ed_load_15min": ["window_start"],
        "active_patients": bi.queue_order(),
        "historical_context": ["match_level", "triage_level", "age_group", "arrival_hour"],
    }
    for name, df in stored.items():
        bi.assert_contract(df, name)
        write_csv(df, f"{folder}/{name}", order.get(name))
    listed = bi.manifest(stored)
    write_document(listed, f"{folder}/manifest")
    return listed, validate_export(spark, listed, folder)
