"""Shared pieces: reading the tables, numbering rows, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from edops.session import stage

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_RUN = 4_096
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS = 512  # texts per Arrow batch


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def named(column: str) -> Column:
    """The column of exactly that name, which may hold dots and back-ticks."""
    return F.col("`" + column.replace("`", "``") + "`")


def whole_row(columns: Sequence[str]) -> Column:
    """All columns as one struct, so that no name can clash."""
    return F.struct(*[named(c) for c in columns])


def unit_draw(*parts: Column | int) -> Column:
    """A uniform draw in [0, 1) that depends on the given values only."""
    columns = [F.lit(p) if isinstance(p, int) else p for p in parts]
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def number_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, rows_per_run: int = ROWS_PER_RUN
) -> DataFrame:
    """Add ``name``: gapless numbers from 0 within each group, without a task per group.

    Rows are dealt by a hash of ``order`` into runs of about ``rows_per_run`` rows. A run is
    numbered by itself; one small row per run carries the rows before it. The order inside a
    group is (hash, ``order``); rows equal in all of ``order`` are interchangeable. ``df``
    must be a stored table, as it is read twice. Null groups count as one group.
    """
    rows = df.count()
    runs = max(1, -(-rows // rows_per_run))
    keys = [f"_g{i}" for i in range(len(group))]
    dealt = df.withColumn("_run", F.pmod(F.xxhash64(*order), F.lit(runs)))
    sizes = dealt.groupBy(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col("_run").alias("_r")).count()
    # The runs of a group are totalled in two levels, so that no task meets all of them.
    sizes = sizes.withColumn("_block", F.floor(F.col("_r") / F.lit(1024)))
    tops = [f"_t{i}" for i in range(len(group))]
    blocks = sizes.groupBy(*[F.col(k).alias(t) for k, t in zip(keys, tops)], F.col("_block").alias("_b")).agg(
        F.sum("count").alias("_n")
    )
    before = Window.partitionBy(*tops).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_to_block", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    inside = Window.partitionBy(*keys, "_block").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_to_run", F.coalesce(F.sum("count").over(inside), F.lit(0)))
    same_block = [F.col(k).eqNullSafe(F.col(t)) for k, t in zip(keys, tops)] + [F.col("_block") == F.col("_b")]
    offsets = sizes.join(blocks, same_block).select(
        *keys, "_r", (F.col("_to_block") + F.col("_to_run")).alias("_offset")
    )
    local = Window.partitionBy(*group, "_run").orderBy(*order)
    numbered = dealt.withColumn("_at", F.row_number().over(local) - 1)
    same = [F.col(g).eqNullSafe(F.col(k)) for g, k in zip(group, keys)] + [F.col("_run") == F.col("_r")]
    joined = numbered.join(offsets, same)
    return joined.select(*[df[c] for c in df.columns], (F.col("_offset") + F.col("_at")).cast("long").alias(name))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(id, component): the smallest id that each endpoint reaches; ids without edges are absent.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every step joins each
    node's neighbours to the smallest one, so chains shrink to stars in a logarithmic number
    of rounds. Each round is written to the shared folder. The minimum per node is a partial
    aggregate and the join back is splittable, so a hub costs no single task.
    """
    pairs = edges.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).filter("u <> v")
    stars = stage(pairs.distinct(), "edges")
    print_of = None
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, larger=True)
        small = _star(large, larger=False)
        stars = stage(small.distinct(), "edges")
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == print_of:
            break
        print_of = tuple(now)
    roots = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Link the larger neighbours (or the smaller ones and the node) to the smallest neighbour."""
    least = links.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("c", "m")) if larger else least
    joined = links.join(least, F.col("u") == F.col("c"))
    if larger:
        return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("c").alias("u"), F.col("m").alias("v")))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send at most ``rows`` rows to Python at once, so that long texts or lists fit in memory.

    Only what runs inside the block is affected, so results are stored there.
    """
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)
