"""Exact order statistics per group for any numeric measure, without a task per group.

Every wanted rank of a group is a search. A pass sketches the values that a search still has
to consider (mergeable quantile summaries, a bounded state per task), which gives two values
that enclose the rank for certain; the next pass counts the values below, at and between
them: the rank is one of the two, or the search goes on strictly between. There a round
leaves about ``6 * MARGIN`` of the values, however often others repeat, so a thousand million
values take three or four rounds. Searches with at most ``FEW``
values left end with a running count over their distinct values. Hot groups are summed by
partial aggregates only, and no window holds more than ``FEW`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from edops.session import stage

FEW = 50_000
ACCURACY = 2_000  # a sketch's ranks are off by at most one in so many
MARGIN = 2 / ACCURACY
BROADCAST_SEARCHES = 20_000

Rank = Callable[[Column], Column]

#: Zero-based ranks from the number of values.
LOWER_MIDDLE: Rank = lambda n: F.floor((n - 1) / 2)
UPPER_MIDDLE: Rank = lambda n: F.ceil((n - 1) / 2)


def nearest_rank(fraction: float) -> Rank:
    """Rank nearest to a fraction of the way, halves to even."""
    return lambda n: F.rint((n - 1) * F.lit(fraction))


def order_statistics(df: DataFrame, groups: list[str], value: str, ranks: Mapping[str, Rank], few: int | None = None) -> DataFrame:
    """One row per group: its columns, ``n`` (values that are not null) and the value of each rank.

    Null groups count as groups; a group without values has n = 0 and null statistics. NaN
    comes after all numbers.
    """
    few = FEW if few is None else few
    keys = [f"_g{i}" for i in range(len(groups))]
    rows = df.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], F.col(value).cast("double").alias("_v"))
    rows = stage(rows, "measure")
    sizes = stage(rows.groupBy(*keys).agg(F.count("_v").alias("n")), "sizes")
    wanted = F.array(*[F.struct(F.lit(i).alias("rank"), r(F.col("n")).cast("long").alias("k")) for i, r in enumerate(ranks.values())])
    # A search: its group, the rank among the values between lo and hi, and how many these are.
    open_ = stage(
        sizes.filter("n > 0").select(
            *keys, F.inline(wanted), F.col("n").alias("left"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi")
        ),
        "searches",
    )
    found = None
    while True:
        done = _finish(rows, open_.filter(F.col("left") <= few), keys)
        found = done if found is None else found.unionByName(done)
        rest = open_.filter(F.col("left") > few)
        if rest.isEmpty():
            break
        narrowed = stage(_narrow(rows, rest, keys), "searches")
        found = found.unionByName(narrowed.filter("settled").select(*keys, "rank", "_found"))
        open_ = narrowed.filter("not settled").drop("settled", "_found")
    each = [F.max(F.when(F.col("rank") == i, F.col("_found"))).alias(name) for i, name in enumerate(ranks)]
    values = found.groupBy(*keys).agg(*each).select(*[F.col(k).alias(f"_f{k}") for k in keys], *ranks)
    out = sizes.join(values, _same(keys, [f"_f{k}" for k in keys]), "left")
    return out.select(*[F.col(k).alias(g) for g, k in zip(groups, keys)], "n", *ranks)


def _same(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def _considered(rows: DataFrame, searches: DataFrame, keys: list[str]) -> DataFrame:
    """Every value that each search still has to consider, with the search."""
    named = searches.select(*[F.col(k).alias(f"_s{k}") for k in keys], *[c for c in searches.columns if c not in keys])
    named = F.broadcast(named) if searches.count() <= BROADCAST_SEARCHES else named
    inside = (F.col("lo").isNull() | (F.col("_v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("_v") < F.col("hi")))
    return rows.filter("_v is not null").join(named, _same(keys, [f"_s{k}" for k in keys]) & inside)


def _finish(rows: DataFrame, searches: DataFrame, keys: list[str]) -> DataFrame:
    """Value of each search over its few distinct values."""
    counted = _considered(rows, searches, keys).groupBy(*keys, "rank", "k", "_v").agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.partitionBy(*keys, "rank").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counted.withColumn("_reached", F.sum("_n").over(up_to))
    return reached.filter(F.col("_reached") > F.col("k")).groupBy(*keys, "rank").agg(F.min("_v").alias("_found"))


def _narrow(rows: DataFrame, searches: DataFrame, keys: list[str]) -> DataFrame:
    """Each search with its value, if it is settled, or with narrower ends and what is between."""
    values = _considered(rows, searches, keys)
    search = [*keys, "rank", "k", "left", "lo", "hi"]
    grid = [i * MARGIN for i in range(1, round(1 / MARGIN))]
    sketched = values.groupBy(*search).agg(F.percentile_approx("_v", F.array(*map(F.lit, grid)), ACCURACY).alias("_grid"))
    # The grid's values are off by half a step at most, so two steps to each side are safe.
    step = F.floor(F.col("k") / F.col("left") / F.lit(MARGIN)).cast("int")
    ends = stage(sketched.select(*search, _entry(step - 3).alias("_a"), _entry(step + 2).alias("_b")), "ends")
    value, a, b = F.col("_v"), F.col("_a"), F.col("_b")
    counted = _considered(rows, ends, keys).groupBy(*search, "_a", "_b").agg(
        F.count_if(value < a).alias("_below"),
        F.count_if(value == a).alias("_low"),
        F.count_if((a.isNull() | (value > a)) & (b.isNull() | (value < b))).alias("_inside"),
        F.count_if((value == b) & ~b.eqNullSafe(a)).alias("_high"),
    )
    k, low, inside = F.col("k") - F.col("_below"), F.col("_low"), F.col("_inside")
    sure = F.assert_true((k >= 0) & (k < low + inside + F.col("_high")), "A sketch did not enclose its rank")
    at_end = F.when(k < low, a).when(k >= low + inside, b)
    return counted.filter(sure.isNull()).select(
        *keys,
        "rank",
        (k - low).alias("k"),
        inside.alias("left"),
        F.coalesce(a, "lo").alias("lo"),
        F.coalesce(b, "hi").alias("hi"),
        ((k < low) | (k >= low + inside)).alias("settled"),
        at_end.alias("_found"),
    )


def _entry(index: Column) -> Column:
    """A value of the grid; null beyond its ends."""
    return F.when(index >= 0, F.get("_grid", index))
