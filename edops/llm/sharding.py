"""Sharding by a k-d tree over document metadata.

A node of the tree covers a box of metadata and owns a number of shards. It is split at
the weighted median (by bytes, or at the share of the shards that go left) along its
widest dimension, until every leaf is one shard; the number of shards is the total over
the target bytes. Shards are therefore near equal in bytes and close in metadata.

Medians are distributed: the position of a document on a dimension is a whole number of
60 bits (20 bits of the scaled value, then 40 bits of a hash of the text and the key, so
that ties fall apart evenly and equal texts stay next to each other). Bytes are summed per
(node, bin) with map-side combining; the bin that holds the median is opened again until
it carries less than ``TOLERANCE`` of the node. All nodes of a depth are split together,
and no row, node list or histogram goes to the driver.

A string dimension counts by the rank of its value among the distinct values.

Defined cases: null text has 0 bytes; a null in a dimension sorts below every value; very
long texts only count by their bytes, and one above a shard's share fills a shard; a
dimension without spread is never chosen unless all have none, and then the hash alone
splits; equal rows are interchangeable; an empty table gives an empty result; extra columns
are kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from edops.llm.common import number_rows
from edops.session import stage

VALUE_BITS, TIE_BITS, BIN_BITS = 20, 40, 12
KEY_BITS = VALUE_BITS + TIE_BITS
TOLERANCE = 1e-3
BROADCAST_VALUES = 50_000


def _ranked(rows: DataFrame, name: str) -> DataFrame:
    """Replace a string dimension by the rank of its value among the distinct ones; null stays.

    The distinct values are dealt by range and numbered in place, with the numbers before
    each range added; only as many numbers as there are ranges meet on the driver.
    """
    values = rows.filter(F.col(name).isNotNull()).select(F.col(name).alias("_value")).distinct()
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = stage(values.repartitionByRange(parts, "_value").withColumn("_part", F.spark_partition_id()), "shard-values")
    held = {r["_part"]: r["count"] for r in values.groupBy("_part").count().collect()}
    before, total = [0] * (max(held, default=0) + 1), 0
    for part in sorted(held):
        before[part], total = total, total + held[part]
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_value")) + F.array(*map(F.lit, before))[F.col("_part")]
    ranks = values.select("_value", place.cast("double").alias("_rank"))
    ranks = F.broadcast(ranks) if total <= BROADCAST_VALUES else ranks
    joined = rows.join(ranks, F.col(name) == F.col("_value"), "left").drop("_value")
    return joined.withColumn(name, F.col("_rank")).drop("_rank")


def _scaled(df: DataFrame, names: list[str]) -> DataFrame:
    """Replace each dimension by its place in the global range, 0 to 2^20 - 1; null is 0."""
    ends = df.agg(*[f(n).alias(f"{n}_{k}") for n in names for k, f in (("lo", F.min), ("hi", F.max))]).first()
    top = float((1 << VALUE_BITS) - 1)

    def place(name: str) -> Column:
        lo, hi = ends[f"{name}_lo"], ends[f"{name}_hi"]
        if lo is None or hi <= lo:
            return F.lit(0).cast("long")
        return F.coalesce(F.floor((F.col(name) - F.lit(lo)) / F.lit(hi - lo) * F.lit(top)), F.lit(0)).cast("long")

    return df.withColumns({n: place(n) for n in names})


def kd_shards(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    key: str = "doc_id",
    text: str = "text",
    target_bytes: int | None = None,
    shards: int | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: key, _size (text bytes + 1), _crc, _shard, _slot.

    Give either ``target_bytes`` per shard or the number of ``shards``. ``_slot`` numbers
    the rows of a shard from 0 without gaps. The text is read once; the tree is built over
    a stored table of sizes and positions.
    """
    names = [f"_d{i}" for i in range(len(dimensions))]
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("crc"),
        F.concat(
            F.lpad(F.hex(F.pmod(F.xxhash64(body), F.lit(1 << 24))), 6, "0"),
            F.lpad(F.hex(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 16))), 4, "0"),
        ).alias("tie"),
        *[c.alias(n) for n, c in zip(names, dimensions.values())],
    ).withColumn("tie", F.conv("tie", 16, 10).cast("long"))
    texts = [n for n in names if isinstance(rows.schema[n].dataType, T.StringType)]
    rows = stage(rows.withColumns({n: F.col(n).cast("double") for n in names if n not in texts}), "shard-rows")
    for n in texts:
        rows = _ranked(rows, n)
    rows = stage(rows, "shard-ranks") if texts else rows
    total = rows.agg(F.sum("size")).first()[0] or 0
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    level = _scaled(rows, names).withColumns({"node": F.lit(0).cast("long"), "parts": F.lit(shards).cast("long")})
    level = stage(level, "shard-level")
    depth = shards
    while depth > 1:
        level = _split(level, names, tolerance)
        depth = -(-depth // 2)
    # A node carries the number of its first shard.
    leaves = stage(level.select("key", "size", "crc", F.col("node").alias("shard")), "shard-leaves")
    return number_rows(leaves, ["shard"], ["key", "crc", "size"], "slot").select(
        "key", *[F.col(c).alias(f"_{c}") for c in ("size", "crc", "shard", "slot")]
    )


def _split(level: DataFrame, names: list[str], tolerance: float) -> DataFrame:
    """Split every node that owns more than one shard; returns the stored next level."""
    ranges = level.filter("parts > 1").groupBy("node", "parts").agg(
        F.sum("size").alias("bytes"), *[(F.max(n) - F.min(n)).alias(n) for n in names]
    )
    widest = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    axis = F.coalesce(*[F.when(F.col(n) == F.col("_widest"), F.lit(i)) for i, n in enumerate(names)])
    nodes = ranges.withColumn("_widest", widest).select(
        F.col("node").alias("n"),
        axis.alias("axis"),
        F.floor(F.col("parts") / 2).alias("left"),
        # Bytes that still have to be found to the left of the cut, from ``lo`` on.
        (F.col("bytes") * F.floor(F.col("parts") / 2) / F.col("parts")).alias("need"),
        (F.col("bytes") * F.lit(tolerance)).alias("slack"),
        F.lit(0).cast("long").alias("lo"),
        F.lit(KEY_BITS).alias("bits"),
        F.lit(False).alias("found"),
    )
    nodes = stage(nodes, "shard-nodes")
    spread = F.coalesce(*[F.when(F.col("axis") == i, F.col(n)) for i, n in enumerate(names)])
    place = (spread * F.lit(1 << TIE_BITS) + F.col("tie")).cast("long")
    bits = KEY_BITS
    while bits > 0:
        width = 1 << (bits - BIN_BITS)
        inside = level.join(nodes.filter("not found"), F.col("node") == F.col("n")).withColumn("place", place)
        inside = inside.filter((F.col("place") >= F.col("lo")) & (F.col("place") < F.col("lo") + F.lit(1 << bits)))
        bins = inside.groupBy("n", F.floor((F.col("place") - F.col("lo")) / F.lit(width)).alias("bin")).agg(
            F.sum("size").alias("bytes")
        )
        sums = bins.withColumn("to", F.sum("bytes").over(Window.partitionBy("n").orderBy("bin")))
        nodes = stage(_narrow(nodes, sums, width), "shard-nodes")
        bits -= BIN_BITS
        if nodes.filter("not found").isEmpty():
            break
    cut = nodes.select("n", "axis", "left", F.col("lo").alias("cut"))
    joined = level.join(cut, F.col("node") == F.col("n"), "left")
    right = F.coalesce(place >= F.col("cut"), F.lit(False))
    moved = joined.withColumns(
        {
            "node": F.when(right, F.col("node") + F.col("left")).otherwise(F.col("node")),
            "parts": F.when(F.col("left").isNull(), F.col("parts"))
            .when(right, F.col("parts") - F.col("left"))
            .otherwise(F.col("left")),
        }
    )
    return stage(moved.select(*level.columns), "shard-level")


def _narrow(nodes: DataFrame, sums: DataFrame, width: int) -> DataFrame:
    """Move each open node's range to the bin that holds its median.

    A node is settled when that bin is light or one key wide; the cut is then the nearer
    side of the bin.
    """
    holds = sums.join(nodes.select(F.col("n").alias("_n"), "need"), F.col("n") == F.col("_n"))
    pick = holds.filter(F.col("to") >= F.col("need")).groupBy("_n").agg(
        F.min(F.struct("bin", "bytes", "to")).alias("b")
    )
    joined = nodes.join(pick, F.col("n") == F.col("_n"), "left")
    start = F.col("lo") + F.col("b.bin") * F.lit(width)
    rest = F.col("need") - (F.col("b.to") - F.col("b.bytes"))
    light = (F.col("b.bytes") <= F.col("slack")) | F.lit(width == 1)
    nearer = F.when(rest * 2 < F.col("b.bytes"), start).otherwise(start + F.lit(width))
    hit = ~F.col("found") & F.col("b").isNotNull()
    return joined.select(
        "n",
        "axis",
        "left",
        F.when(hit, rest).otherwise(F.col("need")).alias("need"),
        "slack",
        F.when(hit & light, nearer).when(hit, start).otherwise(F.col("lo")).alias("lo"),
        F.col("found").__or__(light & hit | F.col("b").isNull()).alias("found"),
    )
