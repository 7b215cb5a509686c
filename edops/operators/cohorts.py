"""Historical cohorts: multi-level roll-up and most-specific lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from edops.functions.numeric import rnd
from edops.operators.running import heavy_keys
from edops.schemas import AGE_BANDS, OLDEST_BAND
from edops.session import stage

ALL = "ALL"
UNKNOWN = "UNKNOWN"
BROADCAST_ROWS = 50_000  # of one level
SALTS = 64
# Levels from most to least specific, with the dimensions each one keeps.
LEVELS: list[tuple[str, list[str]]] = [
    ("TRIAGE_AGE_HOUR", ["triage_level", "age_group", "arrival_hour"]),
    ("TRIAGE_AGE", ["triage_level", "age_group"]),
    ("TRIAGE", ["triage_level"]),
    ("OVERALL", []),
]
DIMENSIONS = ["triage_level", "age_group", "arrival_hour"]
MEASURES = {"wait": "waiting_time_minutes", "los": "length_of_stay_minutes"}


def age_band(age: Column) -> Column:
    band = F.lit(OLDEST_BAND)
    for upper, label in reversed(AGE_BANDS):
        band = F.when(age < upper, label).otherwise(band)
    return F.when(age.isNull(), UNKNOWN).otherwise(band)


def triage_key(triage: Column) -> Column:
    """Unknown (NULL or 0) triage counts as ALL."""
    return F.coalesce(F.nullif(triage, F.lit(0)).cast("string"), F.lit(ALL))


def hour_key(hour: Column) -> Column:
    return F.coalesce(hour.cast("string"), F.lit(ALL))


def cohort_key(level: Column, triage: Column, age: Column, hour: Column) -> Column:
    return F.concat_ws("|", level, triage, age, hour)


def band_number(age: Column) -> Column:
    """Position of the age band; unknown ages get a number of their own."""
    reached = [(age >= upper).cast("int") for upper, _ in AGE_BANDS]
    return F.coalesce(sum(reached[1:], reached[0]), F.lit(len(AGE_BANDS) + 1))


def band_label(number: Column) -> Column:
    labels = [label for _, label in AGE_BANDS] + [OLDEST_BAND, UNKNOWN]
    return F.get(F.array(*[F.lit(label) for label in labels]), number)


def value_histogram(visits: DataFrame, measures: dict[str, str] = MEASURES) -> DataFrame:
    """Rows per (triage, age band, hour, measure, value): the only pass over the visits.

    The map side already merges equal values, so the shuffle carries one row per
    distinct value, not per visit. Minutes come from four-digit fields, which bounds
    every cohort to 10,000 values per measure. Keys are numbers; labels come last.
    """
    values = F.array(
        *[
            F.struct(F.lit(i).alias("measure"), F.col(column).cast("double").alias("value"))
            for i, column in enumerate(measures.values())
        ]
    )
    return (
        visits.select(
            F.nullif(F.col("triage_level"), F.lit(0)).cast("int").alias("triage_level"),
            band_number(F.col("age")).alias("age_group"),
            F.col("arrival_hour").cast("int").alias("arrival_hour"),
            F.coalesce(F.col("admitted_flag"), F.lit(False)).cast("long").alias("admitted"),
            F.inline(values),
        )
        .groupBy(*DIMENSIONS, "measure", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("admitted").alias("admitted"))
    )


def roll_up(histogram: DataFrame, levels: list[tuple[str, list[str]]] = LEVELS) -> DataFrame:
    """Count each histogram row in every level.

    Dimensions outside a level are NULL, and so is an unknown triage or hour inside
    one; the level keeps a cohort of unknown triage apart from the overall one.
    """
    targets = F.array(
        *[
            F.struct(
                F.lit(i).alias("level"),
                *[(F.col(d) if d in kept else F.lit(None).cast("int")).alias(d) for d in DIMENSIONS],
            )
            for i, (_, kept) in enumerate(levels)
        ]
    )
    return (
        histogram.select("measure", "value", "n", "admitted", F.inline(targets))
        .groupBy("level", *DIMENSIONS, "measure", "value")
        .agg(F.sum("n").alias("n"), F.sum("admitted").alias("admitted"))
    )


def build_cohorts(
    visits: DataFrame,
    measures: dict[str, str] = MEASURES,
    fraction: float = 0.9,
    levels: list[tuple[str, list[str]]] = LEVELS,
) -> DataFrame:
    """Cohort table: counts, means, exact medians, nearest-rank percentiles, admission rate."""
    groups = ["level", *DIMENSIONS]
    # NULL values only count towards the cohort size.
    counted = roll_up(value_histogram(visits, measures), levels)
    cohort = Window.partitionBy(*groups, "measure")
    up_to = cohort.orderBy(F.col("value").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    known = F.when(F.col("value").isNotNull(), F.col("n"))
    ranked = counted.withColumn("reached", F.sum(known).over(up_to)).withColumn(
        "total", F.sum(known).over(cohort)
    )

    def at(index: Column, mine: Column) -> Column:
        """Smallest value whose running count passes the zero-based index."""
        return F.min(F.when(mine & (F.col("reached") > index), F.col("value")))

    last = (F.col("total") - 1).cast("double")
    columns = []
    for i, name in enumerate(measures):
        mine = F.col("measure") == i
        weighted = F.sum(F.when(mine, F.col("value") * F.col("n")))
        middle = (at(F.floor(last / 2), mine) + at(F.ceil(last / 2), mine)) / F.lit(2.0)
        nearest = at(F.rint(last * F.lit(fraction)), mine)
        columns += [
            rnd(weighted / F.sum(F.when(mine, known)), 2).alias(f"avg_{name}_minutes"),
            rnd(middle, 2).alias(f"median_{name}_minutes"),
            rnd(nearest, 2).alias(f"p{round(fraction * 100)}_{name}_minutes"),
        ]
    # Each visit appears once per measure; the first one carries the cohort totals.
    size = F.sum(F.when(F.col("measure") == 0, F.col("n")))
    admitted = F.sum(F.when(F.col("measure") == 0, F.col("admitted")))
    grouped = ranked.groupBy(*groups).agg(
        size.alias("patient_count"),
        *columns,
        rnd(admitted.cast("double") / size, 6).alias("admission_rate"),
    )
    labels = {
        "match_level": F.get(F.array(*[F.lit(name) for name, _ in levels]), F.col("level")),
        "triage_level": F.coalesce(F.col("triage_level").cast("string"), F.lit(ALL)),
        "age_group": F.coalesce(band_label(F.col("age_group")), F.lit(ALL)),
        "arrival_hour": F.coalesce(F.col("arrival_hour").cast("string"), F.lit(ALL)),
    }
    shown = [c for c in grouped.columns if c not in groups]
    return grouped.select(
        cohort_key(*labels.values()).alias("cohort_key"),
        *[column.alias(name) for name, column in labels.items()],
        *shown,
    )


def match_cohorts(
    states: DataFrame, cohorts: DataFrame, triage: Column, age: Column, hour: Column
) -> DataFrame:
    """Add ``cohort``: the row of the most specific cohort that exists.

    The cohort table is stored once and its rows are counted by level. Built from survey
    visits it has at most 6 triage x 6 age x 101 hour keys plus the coarser levels (3,679
    rows), and every level is broadcast. A level above ``BROADCAST_ROWS`` is joined by
    exchange: states of a heavy key are dealt over ``SALTS`` copies of its cohort, so no
    task holds them all. A state without any cohort, not even the overall one, is an error.
    """
    cohorts = stage(cohorts, "cohorts")
    level_of = F.substring_index("cohort_key", "|", 1)
    sizes = cohorts.agg(*[F.count_if(level_of == level).alias(level) for level, _ in LEVELS]).first()
    small = {level for level, _ in LEVELS if sizes[level] <= BROADCAST_ROWS}
    keys = {"triage_level": triage_key(triage), "age_group": age_band(age), "arrival_hour": hour_key(hour)}
    out = states.withColumns({f"_{name}": value for name, value in keys.items()})
    wanted = {
        level: cohort_key(F.lit(level), *[F.col(f"_{d}") if d in kept else F.lit(ALL) for d in DIMENSIONS])
        for level, kept in LEVELS
    }
    large = [level for level, kept in LEVELS if kept and level not in small]
    if large:
        out = stage(out.withColumns({f"_wanted_{level}": wanted[level] for level in large}), "states")
        heavy = heavy_keys(out, *[f"_wanted_{level}" for level in large])
    matches = []
    for i, (level, kept) in enumerate(LEVELS):
        of_level = cohorts.filter(level_of == level)
        if not kept:  # one cohort for all rows: a value, not a join
            matches.append(of_level.filter(F.col("cohort_key") == wanted[level]).select(F.struct("*")).scalar())
            continue
        side = of_level.select(F.col("cohort_key").alias(f"_key{i}"), F.struct("*").alias(f"_match{i}"))
        if level in small:
            out = out.join(F.broadcast(side), wanted[level] == F.col(f"_key{i}"), "left")
        else:
            out = _salted(out, side, f"_wanted_{level}", f"_key{i}", heavy[f"_wanted_{level}"])
        matches.append(F.col(f"_match{i}"))
    missing = F.raise_error(F.lit("No cohort matches and there is no overall cohort"))
    found = out.select(*states.columns, F.coalesce(*matches).alias("cohort"))
    return found.withColumn(
        "cohort", F.coalesce(F.col("cohort"), missing.cast(cohorts.schema))
    )


def _salted(states: DataFrame, side: DataFrame, wanted: str, key: str, heavy: list) -> DataFrame:
    """Left join by exchange; rows of heavy keys are dealt over copies of their partner."""
    if not heavy:
        return states.join(side, F.col(wanted) == F.col(key), "left")
    salt = F.when(F.col(wanted).isin(heavy), F.pmod(F.xxhash64(*states.columns), F.lit(SALTS)))
    dealt = states.withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int"))
    copies = F.when(F.col(key).isin(heavy), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = side.withColumn("_copy", F.explode(copies))
    same = (F.col(wanted) == F.col(key)) & (F.col("_salt") == F.col("_copy"))
    return dealt.join(copied, same, "left").drop("_salt", "_copy")
