"""Index of known event ids: hash buckets with a Bloom filter for each part.

Every batch adds a segment: its ids in ``BUCKETS`` parts by a hash, and a blocked Bloom filter
of each part. ``FAN`` segments of one size are merged into one, so after N batches there are
at most ``FAN`` times log N of them, and an id is rewritten log N times. A batch probes the
filters with its own ids and opens only parts that may hold one of them; the exact
comparison with those parts removes the false ones. Filters are small tables (about four
bytes an id) that are probed by a join; nothing but part numbers comes to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edops.streaming.parts import read_or_empty, spread

BUCKETS, FAN = 32, 8
LANES, IDS_PER_BLOCK = 8, 16  # a block has 8 times 64 bits, an id sets one in each
SEGMENTS = "array<struct<first: long, batches: long, ids: long, blocks: long>>"
KNOWN = "event_id string, event_ts timestamp"
_BLOCK = ", ".join(["block long", *(f"lane{i} long" for i in range(LANES))])


def _bucket(ids: Column) -> Column:
    return F.pmod(F.xxhash64(ids), F.lit(BUCKETS)).cast("int")


def _bit(ids: Column, lane: int) -> Column:
    """The id's bit of a lane as a 64-bit mask."""
    six = F.shiftrightunsigned(F.xxhash64(ids, F.lit(1)), 6 * lane).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), six)


def _block(ids: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(ids, F.lit(2)), blocks)


@dataclass(frozen=True)
class Segment:
    """Ids of ``batches`` batches from ``first`` on; ``blocks`` blocks in each part's filter."""

    first: int
    batches: int
    ids: int
    blocks: int

    @property
    def name(self) -> str:
        return f"{self.first}-{self.batches}"


@dataclass
class IdIndex:
    spark: SparkSession
    path: str

    def _ids(self, segment: Segment, buckets: list[int] | None = None) -> DataFrame:
        root = f"{self.path}/parts/{segment.name}"
        if buckets is None:
            return read_or_empty(self.spark, f"{KNOWN}, bucket int", root).drop("bucket")
        return self.spark.read.schema(KNOWN).parquet(*[f"{root}/bucket={b}" for b in buckets])

    def write(self, ids: DataFrame, first: int, batches: int, count: int) -> Segment:
        """Store a segment of about ``count`` ids: the parts, then the filters read off them."""
        name = f"{first}-{batches}"
        parts, filters = f"{self.path}/parts/{name}", f"{self.path}/filters/{name}"
        rows = ids.select("event_id", "event_ts", _bucket(F.col("event_id")).alias("bucket"))
        spread(rows, "bucket", BUCKETS).write.mode("overwrite").partitionBy("bucket").parquet(parts)
        blocks = -(-max(1, count) // (BUCKETS * IDS_PER_BLOCK))
        block = _block(F.col("event_id"), F.lit(blocks)).alias("block")
        lanes = [F.bit_or(_bit(F.col("event_id"), i)).alias(f"lane{i}") for i in range(LANES)]
        stored = read_or_empty(self.spark, f"{KNOWN}, bucket int", parts).select("event_id", "bucket")
        stored.groupBy("bucket", block).agg(*lanes).hint("rebalance").write.mode("overwrite").parquet(filters)
        return Segment(first, batches, count, blocks)

    def add(self, ids: DataFrame, batch_id: int, before: list[Segment], count: int) -> list[Segment]:
        """The segments after a batch with ``count`` new (event_id, event_ts); may be repeated."""
        segments = [*before, self.write(ids, batch_id, 1, count)]
        while len(segments) >= FAN and len({s.batches for s in segments[-FAN:]}) == 1:
            merged = segments[-FAN:]
            whole = reduce(DataFrame.unionByName, [self._ids(s) for s in merged])
            segments[-FAN:] = [self.write(whole, merged[0].first, sum(s.batches for s in merged), sum(s.ids for s in merged))]
        return segments

    def parts_of(self, ids: DataFrame, segments: list[Segment]) -> dict[Segment, list[int]]:
        """The parts of each segment that may hold one of the ids (column event_id)."""
        if not segments:
            return {}
        numbered = F.array(*[F.struct(F.lit(i).alias("segment"), F.lit(s.blocks).alias("blocks")) for i, s in enumerate(segments)])
        asked = ids.select("event_id", _bucket(F.col("event_id")).alias("bucket"), F.inline(numbered))
        asked = asked.withColumn("block", _block(F.col("event_id"), F.col("blocks")))
        filters = [
            read_or_empty(self.spark, f"{_BLOCK}, bucket int", f"{self.path}/filters/{s.name}").withColumn("segment", F.lit(i))
            for i, s in enumerate(segments)
        ]
        met = asked.join(reduce(DataFrame.unionByName, filters), ["segment", "bucket", "block"])
        held = [F.col(f"lane{i}").bitwiseAND(_bit(F.col("event_id"), i)) != 0 for i in range(LANES)]
        # At most as many rows as there are parts.
        hits = met.filter(reduce(Column.__and__, held)).select("segment", "bucket").distinct().collect()
        found: dict[Segment, list[int]] = {}
        for r in sorted(hits, key=lambda r: (r["segment"], r["bucket"])):
            found.setdefault(segments[r["segment"]], []).append(r["bucket"])
        return found

    def known(self, ids: DataFrame, segments: list[Segment]) -> DataFrame:
        """(event_id, event_ts) of all parts that may hold one of the ids; the ids themselves among them."""
        parts = [self._ids(s, buckets) for s, buckets in self.parts_of(ids, segments).items()]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], KNOWN)

    def all(self, segments: list[Segment]) -> DataFrame:
        parts = [self._ids(s) for s in segments]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], KNOWN)
