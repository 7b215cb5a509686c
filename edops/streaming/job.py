"""Micro-batch job: raw events to a ledger, open visits and quality counters.

Layout below the output folder, one partition per batch:

    ledger/batch_id=N     every row of the batch with its outcome and errors
    episodes/batch_id=N   completed=false: open visits of the buckets that the batch touches;
                          completed=true: visits closed in the batch
    open_parts            for each batch a document: which batch holds the visits of each bucket
    known/                index of accepted event ids, see ``ids``
    marks/batch_id=N      high-water mark, counters, segments of the index and run
    load/batch_id=N       what the batch adds to each 15-minute window, written last
    parsed                the batch in work, parsed and ordered

What a batch reads and writes follows its own size, not the history: of the open visits only
the buckets that its events touch, of the known ids only the parts whose filters may hold
one of its own. Batch N reads what N-1 left and overwrites its own folders, so a repeated
batch gives the same result. A batch without its mark has not happened: no reader shows it.
Only the newest batch can be repeated, and only by the run that wrote it, so a run whose
numbering starts again cannot replace stored batches; a batch that has its mark is not
computed again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from edops.functions.times import from_micros
from edops.operators.contract import EVENT_COLUMNS, flatten_events, parse_events
from edops.operators.events import (
    ACCEPTED,
    DUPLICATE,
    INVALID,
    LATE,
    ORPHAN,
    before_watermark,
    mark_duplicates,
    stream_counters,
)
from edops.operators.gold import WINDOW_MINUTES
from edops.operators.running import HEAVY_ROWS, SPAN, heavy_keys
from edops.operators.visits import STATE_COLUMNS, current_rows, merge_state, trace_batch
from edops.schemas import PATIENT_EVENTS, STORED_STATE, WATERMARK_MINUTES, names
from edops.session import stage_if
from edops.sources import folders
from edops.streaming.ids import SEGMENTS, IdIndex, Segment
from edops.streaming.parts import PartTable, read_or_empty, spread

BROADCAST_ROWS = 500_000
BUCKETS = 64

_LEDGER = (
    f"{PATIENT_EVENTS}, event_ts timestamp, errors array<string>, raw_value string, "
    "ingest_ts timestamp, seq long, episode long, outcome string"
)
_MARK = (
    "high_water timestamp, records_processed long, records_rejected long, "
    "duplicate_event_ids long, malformed_events long, late_events long, missing_fields long, run string"
)
_COUNTERS = [c.split()[0] for c in _MARK.split(", ")][1:-1]
_MARK += f", segments {SEGMENTS}"
_LOAD = "window_start timestamp, window_end timestamp, new_arrivals long, admissions long, discharges long"


@dataclass
class VisitStream:
    """Settings and folders of one streaming run."""

    spark: SparkSession
    output: str
    watermark_minutes: int = WATERMARK_MINUTES
    # Only look for copies among log entries this much older than the mark; None: all.
    # Copies carry the event time of their original, so a horizon of at least the
    # watermark keeps every acceptance decision; older copies then count as late.
    dedupe_horizon_minutes: int | None = None
    # Open visits and known event ids that a run starts from, as ``write_snapshot`` leaves
    # them; without the ids only the state is taken over.
    initial_state: str | None = None
    initial_ids: str | None = None
    span: int = SPAN
    heavy_rows: int = HEAVY_ROWS
    # Open visits are dealt into so many buckets; a run keeps the number it began with.
    buckets: int = BUCKETS

    # --- folders ---------------------------------------------------------------

    def _path(self, table: str, batch_id: int | None = None) -> str:
        return f"{self.output}/{table}" + ("" if batch_id is None else f"/batch_id={batch_id}")

    def _read(self, schema: str, path: str | None) -> DataFrame:
        return read_or_empty(self.spark, schema, path)

    @property
    def _open(self) -> PartTable:
        """Open visits by bucket."""
        place = lambda batch_id: self._path("episodes", batch_id) + "/completed=false"
        return PartTable(self.spark, self._path("open_parts"), STORED_STATE, "bucket", place)

    @property
    def _known(self) -> IdIndex:
        return IdIndex(self.spark, self._path("known"))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("visit_id"), F.lit(self.buckets)).cast("int")

    def _mark_row(self, batch_id: int):
        """High-water mark and counters of a batch; None while it is not complete."""
        marks = self._read(_MARK, self._path("marks", batch_id))
        return marks.select("*", F.unix_micros("high_water").alias("mark")).first()

    # --- previous batch ----------------------------------------------------------

    def state(self, batch_id: int, buckets: list[int] | None = None) -> DataFrame:
        """Open visits after a batch, of all buckets or of some; batch -1 is the start of the run."""
        if batch_id >= 0:
            return self._open.read(batch_id, buckets)
        return self._read(STORED_STATE, self.initial_state).select(*STATE_COLUMNS)

    def mark(self, batch_id: int) -> int | None:
        """High-water mark after a batch, in microseconds (one value)."""
        if batch_id >= 0:
            return self._mark_row(batch_id)["mark"]
        return self.state(-1).agg(F.unix_micros(F.max("last_event_time"))).first()[0]

    def segments(self, batch_id: int) -> list[Segment]:
        """Segments of the id index after a batch."""
        if batch_id < 0:
            return []
        return _segments(self._mark_row(batch_id))

    def _first_segments(self) -> list[Segment]:
        """The index that a run starts with: the ids of its snapshot."""
        if self.initial_ids is None:
            return []
        ids = self._read("event_id string", self.initial_ids).withColumn("event_ts", F.lit(None).cast("timestamp"))
        return [self._known.write(ids, -1, 0, ids.count())]

    def log_ids(self, batch_id: int) -> DataFrame:
        """Accepted event ids of all batches before ``batch_id``, those of the snapshot included."""
        if batch_id <= 0:
            return self._read("event_id string", self.initial_ids)
        return self._known.all(self.segments(batch_id - 1)).select("event_id")

    def _possible_copies(self, ids: DataFrame, segments: list[Segment], mark: int | None) -> DataFrame:
        """Known ids that may be among these; all that are, within the horizon, are there."""
        limit = None
        if self.dedupe_horizon_minutes is not None and mark is not None:
            limit = from_micros(mark) - F.expr(f"INTERVAL {int(self.dedupe_horizon_minutes)} MINUTES")
            # No event is newer than its batch's mark, so older segments are not opened.
            recent = self._marks().filter(F.col("high_water") >= limit)
            first = recent.agg(F.min("batch_id")).first()[0]
            segments = [s for s in segments if s.first < 0 or s.first + s.batches > first]
        known = self._known.known(ids, segments)
        if limit is not None:
            known = known.filter(F.col("event_ts").isNull() | (F.col("event_ts") >= limit))
        return known.select("event_id")

    def write_snapshot(self, path: str) -> None:
        """Store what another run needs to start from here: ``state`` and ``event_ids``."""
        last = self.last_batch()
        if last is None:
            raise ValueError("No batch is complete")
        self.state(last).write.mode("errorifexists").parquet(f"{path}/state")
        self.log_ids(last + 1).write.mode("errorifexists").parquet(f"{path}/event_ids")

    # --- one batch -----------------------------------------------------------------

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Classify a batch and continue the stored state. Safe to repeat."""
        last, run = self.last_batch(), self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if last is not None and batch_id <= last:
            self._refuse_other_run(batch_id, last, run)
        elif batch_id > (-1 if last is None else last) + 1:
            raise ValueError(f"Batch {batch_id} needs batch {batch_id - 1}, which is not complete")
        else:
            self._compute(batch, batch_id, run)
        self._publish_load(batch_id)

    def _compute(self, batch: DataFrame, batch_id: int, run: str | None) -> None:
        """Everything of a batch up to its mark."""
        before = batch_id - 1
        parsed = self._parse(batch)
        broken = F.size("errors") > 0
        valid = parsed.filter(~broken)
        heavy = heavy_keys(valid, "event_id", "visit_id", heavy_rows=self.heavy_rows)
        size, touched = valid.agg(F.count(F.lit(1)), F.collect_set(self._bucket())).first()
        if before >= 0:
            previous = self._mark_row(before)
            mark, segments = previous["mark"], _segments(previous)
        else:  # before the first batch nothing is in buckets yet
            mark, segments, touched = self.mark(before), self._first_segments(), None
        state = self.state(before, touched)
        ids = valid.select("event_id").distinct()
        checked = self._check(valid, self._possible_copies(ids, segments, mark), size, mark, heavy)
        checked = stage_if(any(heavy.values()), checked, "checked")
        traced = trace_batch(state, checked, heavy, self.span)
        invalid = parsed.filter(broken).withColumn("outcome", F.lit(INVALID))
        ledger = traced.unionByName(invalid, allowMissingColumns=True)
        # Rejected rows keep the text they came with.
        rejected = F.col("outcome").isin(INVALID, LATE, ORPHAN)
        ledger = ledger.withColumn("raw_value", F.when(rejected, F.col("raw_value"))).select(*names(_LEDGER))
        ledger.write.mode("overwrite").parquet(self._path("ledger", batch_id))

        written = self._written(batch_id)
        episodes = merge_state(state, written, heavy, self.span)
        bucket = F.when(~F.col("completed"), self._bucket()).alias("bucket")
        (
            spread(episodes.select(*STATE_COLUMNS, "episode", "completed", bucket), "bucket", self.buckets)
            .write.mode("overwrite")
            .partitionBy("completed", "bucket")
            .parquet(self._path("episodes", batch_id))
        )
        self._open.commit(batch_id, touched or [], before)
        seen = written.filter(F.col("outcome").isin(ACCEPTED, ORPHAN))
        facts = stream_counters(written).withColumn("high_water", seen.agg(F.unix_micros(F.max("event_ts"))).scalar()).first()
        segments = self._known.add(seen.select("event_id", "event_ts"), batch_id, segments, facts["records_processed"])
        high_water = max((m for m in (facts["high_water"], mark) if m is not None), default=None)
        listed = [tuple(vars(s).values()) for s in segments]
        row = (high_water, *[facts[c] for c in _COUNTERS], run, listed)
        marks = self.spark.createDataFrame([row], _MARK.replace("high_water timestamp", "high_water long"))
        marks = marks.withColumn("high_water", F.timestamp_micros("high_water"))
        marks.coalesce(1).write.mode("overwrite").parquet(self._path("marks", batch_id))

    def _written(self, batch_id: int) -> DataFrame:
        """The stored ledger of one batch."""
        return self.spark.read.schema(_LEDGER).parquet(self._path("ledger", batch_id))

    def _publish_load(self, batch_id: int) -> None:
        """Store what a complete batch adds to the windows, in one file and only once.

        The load stream reads these files as they appear; a file that is there is final.
        """
        path = self._path("load", batch_id)
        if not folders.exists(self.spark, path):
            seen = self._written(batch_id).filter(F.col("outcome").isin(ACCEPTED, ORPHAN))
            folders.write_whole(window_counts(seen).coalesce(1), path)

    def _refuse_other_run(self, batch_id: int, last: int, run: str | None) -> None:
        """Stored batches stay as they are; only the newest may come again, from its own run."""
        if batch_id < last:
            raise ValueError(f"Batch {batch_id} is older than the stored batch {last}; use another output folder")
        if self._mark_row(last)["run"] != run:
            raise ValueError(f"Batch {last} was stored by another run; use another output folder")

    def _parse(self, batch: DataFrame) -> DataFrame:
        """Parse once and fix the processing order: event time, then arrival.

        The position is unique, so copies of one event never share a sort key and the
        range sort can split them. The order number is only stable in a written table,
        hence the parsed batch is stored before anything branches off it.
        """
        arrived = batch.withColumn("_position", F.monotonically_increasing_id())
        flat = flatten_events(parse_events(arrived), ("raw_value", "ingest_ts", "_position"))
        # The range sort reads its input twice, once to sample it.
        flat = flat.persist(StorageLevel.MEMORY_AND_DISK)
        ordered = flat.orderBy("event_ts", "_position").drop("_position")
        path = self._path("parsed")
        (
            ordered.withColumn("seq", F.monotonically_increasing_id())
            .write.mode("overwrite")
            .parquet(path)
        )
        flat.unpersist()
        schema = f"raw_value string, ingest_ts timestamp, {PATIENT_EVENTS}, event_ts timestamp, errors array<string>, seq long"
        return self.spark.read.schema(schema).parquet(path)

    def _check(self, valid: DataFrame, known: DataFrame, size: int, mark: int | None, heavy: dict[str, list]) -> DataFrame:
        """Add ``late`` (against the mark of earlier batches) and ``duplicate``.

        A batch is processed in event-time order, so nothing in it is late against its
        own events. Ids already in the log take part as copies that came first.
        """
        late = before_watermark(F.col("event_ts"), from_micros(mark), self.watermark_minutes)
        flagged = valid.withColumn("late", late)
        ids = valid.select("event_id").distinct()
        if size <= BROADCAST_ROWS:
            ids = F.broadcast(ids)  # the parts are then read in place, not exchanged
        known = known.join(ids, "event_id", "left_semi").select(
            "event_id", F.lit(-1).cast("long").alias("seq"), F.lit(False).alias("late")
        )
        both = known.unionByName(flagged, allowMissingColumns=True)
        return mark_duplicates(both, heavy, self.span).filter(F.col("seq") >= 0)

    # --- results -----------------------------------------------------------------

    def _table(self, name: str, schema: str) -> DataFrame:
        """All batches of a table; none were written yet: empty."""
        return self._read(f"{schema}, batch_id int", self._path(name))

    def _complete(self, name: str, schema: str) -> DataFrame:
        """The complete batches of a table; batches follow one another without a gap."""
        last = self.last_batch()
        return self._table(name, schema).filter(F.col("batch_id") <= F.lit(-1 if last is None else last))

    def _marks(self) -> DataFrame:
        return self._table("marks", _MARK)

    def last_batch(self) -> int | None:
        """Newest complete batch; None before the first."""
        return self._marks().agg(F.max("batch_id")).first()[0]

    def ledger(self) -> DataFrame:
        return self._complete("ledger", _LEDGER)

    def event_log(self, accepted_only: bool = False) -> DataFrame:
        """One row per valid event id: applied, orphan and late ones unless narrowed.

        Of a late and a later accepted copy the accepted one is shown, else the earliest.
        """
        kept = [ACCEPTED] if accepted_only else [ACCEPTED, ORPHAN, LATE]
        rows = self.ledger().filter(F.col("outcome").isin(kept))
        rank = F.array_position(F.array(*[F.lit(k) for k in kept]), F.col("outcome"))
        columns = [*EVENT_COLUMNS, "event_ts", "outcome", "batch_id"]
        one = rows.groupBy(F.col("event_id").alias("_id")).agg(
            F.min_by(F.struct(*columns), F.struct(rank.alias("rank"), "batch_id", "seq")).alias("e")
        )
        return one.select("e.*")

    def quarantine(self) -> DataFrame:
        rows = self.ledger().filter(~F.col("outcome").isin(ACCEPTED, DUPLICATE))
        errors = F.when(F.col("outcome") == INVALID, F.col("errors")).otherwise(F.array("outcome"))
        return rows.withColumn("errors", errors)

    def open_visits(self) -> DataFrame:
        """Snapshot after the last committed batch."""
        last = self.last_batch()
        return current_rows(self.state(last), from_micros(self.mark(last)))

    def completed(self) -> DataFrame:
        episodes = self._complete("episodes", f"{STORED_STATE}, episode long, completed boolean, bucket int")
        return episodes.filter("completed").drop("completed", "bucket")

    def counters(self) -> DataFrame:
        return self._marks().agg(*[F.sum(c).alias(c) for c in _COUNTERS])

    # --- streaming queries -----------------------------------------------------------

    def start_state(self, raw: DataFrame, available_now: bool = True, every: str = "10 seconds") -> StreamingQuery:
        """Start the state query on a stream of (raw_value, ingest_ts)."""
        writer = (
            raw.writeStream.foreachBatch(self.process)
            .queryName("visit_state")
            .option("checkpointLocation", self._path("checkpoints/state"))
        )
        return _triggered(writer, available_now, every).start()

    def load_windows(self) -> DataFrame:
        """15-minute load of all complete batches, added up from what each batch stored."""
        flow = ["new_arrivals", "admissions", "discharges"]
        parts = self._complete("load", _LOAD)
        return parts.groupBy("window_start", "window_end").agg(*[F.sum(c).alias(c) for c in flow])

    def start_load(self, available_now: bool = True, every: str = "10 seconds", files: int | None = None) -> StreamingQuery:
        """Start the load query: windows as a streaming aggregate, changed ones kept in a table.

        It follows the state query's batches, whose copies and late events are decided; no
        event that such a batch accepts is older than the watermark allows, so Spark drops
        none and forgets windows that cannot change any more. ``files`` limits the batches
        taken at once.
        """
        folders.create(self.spark, self._path("load"))
        reader = self.spark.readStream.schema(f"{_LOAD}, batch_id int")
        reader = reader.option("maxFilesPerTrigger", files) if files else reader
        flow = ["new_arrivals", "admissions", "discharges"]
        windows = (
            reader.parquet(self._path("load"))
            .withWatermark("window_start", f"{self.watermark_minutes} minutes")
            .groupBy(F.window("window_start", f"{WINDOW_MINUTES} minutes").alias("w"))
            .agg(*[F.sum(c).alias(c) for c in flow])
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *flow)
        )
        writer = (
            windows.writeStream.outputMode("update")
            .foreachBatch(self.upsert_load)
            .queryName("load_windows")
            .option("checkpointLocation", self._path("checkpoints/load"))
        )
        return _triggered(writer, available_now, every).start()

    @property
    def _load_table(self) -> PartTable:
        """Windows by day."""
        place = lambda version: self._path("load_table") + f"/version={version}"
        return PartTable(self.spark, self._path("load_parts"), _LOAD, "day", place)

    def upsert_load(self, changed: DataFrame, batch_id: int) -> None:
        """Put the changed windows in place of the stored ones; rewrites only their days. Safe to repeat."""
        table = self._load_table
        newest = table.newest()
        before = newest if newest is None or newest < batch_id else batch_id - 1
        changed = changed.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
        changed = changed.persist(StorageLevel.MEMORY_AND_DISK)
        days = [r[0] for r in changed.select("day").distinct().collect()]
        kept = table.read(before, days).join(changed.select("window_start"), "window_start", "left_anti")
        kept = kept.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
        table.write(kept.unionByName(changed), batch_id, days, before)
        changed.unpersist()

    def stored_load(self) -> DataFrame:
        """The table that the load query keeps."""
        return self._load_table.read(self._load_table.newest())

    def start_malformed(self, raw: DataFrame, available_now: bool = True, every: str = "10 seconds") -> StreamingQuery:
        """Second query: rows that are not JSON objects, appended as JSON files."""
        writer = (
            malformed_rows(raw)
            .writeStream.format("json")
            .outputMode("append")
            .queryName("malformed_events")
            .option("path", self._path("malformed"))
            .option("checkpointLocation", self._path("checkpoints/malformed"))
        )
        return _triggered(writer, available_now, every).start()


def _segments(mark) -> list[Segment]:
    return [Segment(**r.asDict()) for r in mark["segments"]]


def _triggered(writer, available_now: bool, every: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)


def malformed_rows(raw: DataFrame) -> DataFrame:
    parsed = parse_events(raw)
    return parsed.filter(F.array_contains("errors", "MALFORMED_JSON")).select("raw_value", "ingest_ts")


def run_for(query: StreamingQuery, seconds: float) -> None:
    """Bounded run: wait at most ``seconds``, then stop."""
    query.awaitTermination(seconds)
    query.stop()


def window_counts(events: DataFrame) -> DataFrame:
    """Arrivals, admissions and discharges of a batch per 15-minute window."""
    kind = F.col("event_type")
    return (
        events.groupBy(F.window("event_ts", f"{WINDOW_MINUTES} minutes").alias("w"))
        .agg(
            F.count_if(kind == "ARRIVAL").alias("new_arrivals"),
            F.count_if(kind == "ADMISSION").alias("admissions"),
            F.count_if(kind == "DISCHARGE").alias("discharges"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "new_arrivals",
            "admissions",
            "discharges",
        )
    )
