"""Running aggregates per key that stay balanced when one key holds most rows.

A plain window puts all rows of a key into one task. Here the rows of a *heavy*
key are cut into chunks of consecutive order values. Each chunk is its own window
partition; one small row per chunk carries the totals of the chunks before it. Those rows
are added up in levels, ``FAN`` chunks to a block, ``FAN`` blocks to the next level, so the
totals of a sequence never meet in one task either.
``order`` must be a unique whole number (a line number, a log offset), so a chunk
never holds more than ``span`` rows, however the data is distributed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SPAN = 1 << 17
FAN = 1 << 16
ORDERS = 1 << 63  # order values lie below this
# A key is heavy when it holds over 1/HEAVY_SHARE of the rows and over HEAVY_ROWS rows.
HEAVY_SHARE = 5_000
HEAVY_ROWS = 4_000_000
_TRACKED = 50_000
_GROUPS = 64
_CHUNK = "_chunk"

_TOTAL = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Running:
    """One running aggregate; ``before`` leaves the current row out."""

    name: str
    how: str
    value: Column
    before: bool = False


def heavy_keys(
    df: DataFrame, *keys: str, heavy_rows: int = HEAVY_ROWS
) -> dict[str, list]:
    """Values of each key column (all of one type) that hold an outsized share of the rows.

    One scan with a frequent-items sketch per column: nothing is shuffled by key, and at
    most about ``HEAVY_SHARE`` values per column can come back. ``_GROUPS`` tasks merge the
    sketches of the scan; the counts of the values that those report are then summed by
    value, so no task meets the sketches of all. A value above twice the floor is found
    however its rows lie.
    """
    if df.isEmpty():
        return {key: [] for key in keys}
    part = F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("_part")
    tops = [F.expr(f"approx_top_k(`{key}`, {HEAVY_SHARE}, {_TRACKED})") for key in keys]
    listed = [_labelled(top, i) for i, top in enumerate(tops)]
    # The number of rows travels as the count of a key of its own.
    rows = F.array(F.struct(F.lit(-1).alias("key"), F.lit(None).alias("item"), F.count(F.lit(1)).alias("n")))
    parts = df.groupBy(part).agg(F.concat(rows, *[F.coalesce(x, F.array()) for x in listed]).alias("tops"))
    counts = parts.select(F.inline("tops")).groupBy("key", "item").agg(F.sum("n").alias("n"))
    total = F.max(F.when(F.col("key") == -1, F.col("n"))).over(Window.partitionBy())
    floor = F.greatest(F.lit(heavy_rows), F.col("_rows") / F.lit(HEAVY_SHARE))
    found = counts.filter((F.col("key") == -1) | (F.col("n") > heavy_rows)).withColumn("_rows", total)
    found = found.filter((F.col("key") >= 0) & F.col("item").isNotNull() & (F.col("n") > floor)).collect()
    return {key: sorted(r["item"] for r in found if r["key"] == i) for i, key in enumerate(keys)}


def _labelled(top: Column, number: int) -> Column:
    """The items of a sketch with the number of their key column."""
    return F.transform(
        top, lambda t: F.struct(F.lit(number).alias("key"), t["item"].alias("item"), t["count"].alias("n"))
    )


def _combine(how: str, local: Column, carried: Column) -> Column:
    if how == "sum":
        return F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))
    return (F.greatest if how == "max" else F.least)(local, carried)


def running(
    df: DataFrame,
    order: str,
    measures: Sequence[Running],
    keys: Sequence[str] = (),
    heavy: dict[str, list] | None = None,
    span: int = SPAN,
    orders: int = ORDERS,
) -> DataFrame:
    """Add running aggregates over ``order`` within ``keys``.

    Without ``keys`` the whole table is one sequence and is always cut into chunks.
    With ``keys`` only the rows of ``heavy`` values are cut. ``orders`` bounds the order
    values and with them the number of chunks.
    """
    keys = list(keys)
    heavy = {key: values for key, values in (heavy or {}).items() if values and key in keys}
    split = bool(heavy) or not keys
    if split:
        chunk = F.floor(F.col(order) / F.lit(span)).cast("long")
        if keys:
            chunk = F.when(_is_heavy(heavy), chunk)
        df = df.withColumn(_CHUNK, F.coalesce(chunk, F.lit(-1)))
    parts = keys + ([_CHUNK] if split else [])

    window = Window.partitionBy(*parts).orderBy(order)
    start = Window.unboundedPreceding
    windows = {
        before: window.rowsBetween(start, -1 if before else Window.currentRow)
        for before in (False, True)
    }
    out = df.select(
        "*", *[_TOTAL[m.how](m.value).over(windows[m.before]).alias(m.name) for m in measures]
    )
    if not split:
        return _zero_sums(out, measures)

    # One row per chunk, then the totals of all chunks before it.
    cut = df.filter(_is_heavy(heavy)) if keys else df
    totals = cut.groupBy(*parts).agg(*[_TOTAL[m.how](m.value).alias(m.name) for m in measures])
    carried = _before(totals, keys, measures, -(-orders // span)).select(
        *[F.col(p).alias(f"_c{p}") for p in parts], *[F.col(m.name).alias(f"_c{m.name}") for m in measures]
    )
    same = reduce(lambda a, b: a & b, [F.col(p) == F.col(f"_c{p}") for p in parts])
    joined = out.join(carried, same, "left")
    merged = {m.name: _combine(m.how, F.col(m.name), F.col(f"_c{m.name}")) for m in measures}
    return joined.select(
        *[merged.get(c, F.col(c)).alias(c) for c in out.columns if c != _CHUNK]
    )


def _before(totals: DataFrame, keys: list[str], measures: Sequence[Running], chunks: int) -> DataFrame:
    """Totals of all chunks before each chunk of its sequence; no window holds over ``FAN`` rows."""
    start = Window.unboundedPreceding
    if chunks <= FAN:
        earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(start, -1)
        return totals.select(*keys, _CHUNK, *[_TOTAL[m.how](m.name).over(earlier).alias(m.name) for m in measures])
    blocked = totals.withColumn("_block", F.floor(F.col(_CHUNK) / F.lit(FAN)).cast("long"))
    blocks = blocked.groupBy(*keys, F.col("_block").alias(_CHUNK)).agg(*[_TOTAL[m.how](m.name).alias(m.name) for m in measures])
    above = _before(blocks, keys, measures, -(-chunks // FAN)).select(
        *[F.col(k).alias(f"_a{k}") for k in keys], F.col(_CHUNK).alias("_ablock"), *[F.col(m.name).alias(f"_a{m.name}") for m in measures]
    )
    earlier = Window.partitionBy(*keys, "_block").orderBy(_CHUNK).rowsBetween(start, -1)
    inside = blocked.select(*keys, _CHUNK, "_block", *[_TOTAL[m.how](m.name).over(earlier).alias(m.name) for m in measures])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_a{k}") for k in keys], F.col("_block") == F.col("_ablock"))
    joined = inside.join(above, same, "left")
    return joined.select(*keys, _CHUNK, *[_combine(m.how, F.col(m.name), F.col(f"_a{m.name}")).alias(m.name) for m in measures])


def _is_heavy(heavy: dict[str, list]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(key).isin(values) for key, values in heavy.items()])


def _zero_sums(df: DataFrame, measures: Sequence[Running]) -> DataFrame:
    sums = {m.name: F.coalesce(F.col(m.name), F.lit(0)) for m in measures if m.how == "sum"}
    return df.withColumns(sums) if sums else df
