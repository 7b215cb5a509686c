"""Quality flags of clean visits and the historical quality report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edops.functions.labels import labels_of
from edops.operators.running import Running, heavy_keys, running
from edops.schemas import FLAG_NAMES, NOT_VITAL_FLAGS, RANGE_RULES

REPEATED = "DUPLICATE_VISIT_ID"
_NO_KEY = "\0"


def quality_flags(
    rules: list[tuple[str, float, float]] = RANGE_RULES, key: str = "visit_id"
) -> Column:
    """Array of rule violations in rule order; NULL values pass the range rules."""
    checks = [
        (~F.col(name).between(low, high), FLAG_NAMES.get(name, f"INVALID_{name.upper()}"))
        for name, low, high in rules
    ]
    checks.append((F.col("systolic_bp") <= F.col("diastolic_bp"), "INVALID_BP_RELATION"))
    checks.append((F.coalesce(F.col(key), F.lit("")) == "", "NULL_VISIT_ID"))
    return labels_of(checks)


def quality_status(flags: Column) -> Column:
    return F.when(F.size(flags) == 0, "VALID").otherwise("FLAGGED")


def add_quality(visits: DataFrame) -> DataFrame:
    return visits.withColumn("data_quality_flags", quality_flags()).withColumn(
        "data_quality_status", quality_status(F.col("data_quality_flags"))
    )


def mark_repeats(
    visits: DataFrame, key: str, order: str, heavy: list | None = None
) -> DataFrame:
    """Append ``DUPLICATE_VISIT_ID`` to the second and later rows of each key.

    Adds ``occurrence``, see ``number_repeats``.
    """
    return flag_repeats(number_repeats(visits, key, order, heavy))


def number_repeats(
    visits: DataFrame, key: str, order: str, heavy: list | None = None
) -> DataFrame:
    """Add ``occurrence`` (1 for the first row of each key).

    ``heavy`` defaults to the measured heavy keys, so a key that fills a third of the table
    is still split. Rows without a key repeat each other.
    """
    # Visit ids begin alike, which a sort compares slowly; a number in front parts them at once.
    filled = F.coalesce(F.col(key), F.lit(_NO_KEY))
    keyed = visits.withColumn("_hash", F.xxhash64(filled))
    found = heavy_keys(visits.select(filled.alias("_key")), "_key") if heavy is None else {"_key": heavy}
    if found["_key"]:
        keyed = keyed.withColumn("_key", filled)
    # Without heavy keys the key itself will do, nulls being one group, and is moved once only.
    by = ["_hash", "_key" if found["_key"] else key]
    seen = running(keyed, order, [Running("_before", "sum", F.lit(1), before=True)], by, found)
    return seen.withColumn("occurrence", (F.col("_before") + 1).cast("long")).drop("_before", "_key", "_hash")


def flag_repeats(numbered: DataFrame) -> DataFrame:
    """Append ``DUPLICATE_VISIT_ID`` to the rows that are not the first of their key."""
    flags = F.col("data_quality_flags")
    marked = F.when(F.col("occurrence") > 1, F.array_append(flags, F.lit(REPEATED))).otherwise(flags)
    return numbered.withColumn("data_quality_flags", marked).withColumn(
        "data_quality_status", quality_status(F.col("data_quality_flags"))
    )


def flag_counts(visits: DataFrame) -> DataFrame:
    """Rows per flag, and rows per status, as (flag, records)."""
    labels = F.array_append("data_quality_flags", F.col("data_quality_status"))
    return (
        visits.select(F.explode(labels).alias("flag"))
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def quality_report(visits: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """One-row report of the clean visit table; every count by flag, sorted by name."""
    counts = flag_counts(visits)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("records"))), F.lit(0)).cast("long")

    flag = F.col("flag")
    vital = flag.startswith("INVALID_") & ~flag.isin(NOT_VITAL_FLAGS)
    return counts.agg(
        (generated_at if generated_at is not None else F.current_timestamp()).alias("generated_at"),
        total(flag.isin("VALID", "FLAGGED")).alias("row_count"),
        total(flag == REPEATED).alias("duplicate_visit_ids"),
        total(flag == "NULL_VISIT_ID").alias("null_critical_fields"),
        total(flag == "INVALID_TRIAGE").alias("invalid_triage"),
        total(vital).alias("invalid_vitals"),
        total(flag == "FLAGGED").alias("records_flagged"),
        F.lit(0).cast("long").alias("records_rejected"),
        # At most one entry per flag name, so the map stays tiny.
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct("flag", "records")))
        ).alias("flag_counts"),
    )
