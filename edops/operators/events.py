"""Outcome of every event: duplicate, late, orphan or applied.

The checks run in the order contract, duplicate, late, orphan. Input rows are
valid events with a unique whole-number processing order ``seq``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from edops.operators.running import SPAN, Running, heavy_keys, running
from edops.schemas import TERMINAL_TYPES, WATERMARK_MINUTES
from edops.session import stage, stage_if

ACCEPTED, DUPLICATE, LATE, ORPHAN = "ACCEPTED", "DUPLICATE", "LATE_EVENT", "STATE_WITHOUT_ARRIVAL"
INVALID = "INVALID"
FOLD = 4_096  # disputed copies that are replayed as one array
BROADCAST_IDS = 50_000
FIRST_EPISODE = -2  # below every order, the -1 of a carried-over visit included


def before_watermark(event_ts: Column, mark: Column, minutes: int) -> Column:
    """True when the event is older than the high-water mark allows; no mark, never."""
    limit = mark - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return F.coalesce(event_ts < limit, F.lit(False))


def mark_late(
    events: DataFrame,
    minutes: int = WATERMARK_MINUTES,
    span: int = SPAN,
    raises: Column | None = None,
) -> DataFrame:
    """Add ``late``: older than the running maximum of all earlier events allows.

    The order is global, so the sequence is cut into chunks and only one maximum per
    chunk is carried on. Late events and identical copies cannot raise the maximum:
    they are no newer than an event that came before them. ``raises`` leaves out rows
    for which that does not hold.
    """
    time = F.col("event_ts") if raises is None else F.when(raises, F.col("event_ts"))
    seen = running(events, "seq", [Running("mark", "max", time, before=True)], span=span)
    late = before_watermark(F.col("event_ts"), F.col("mark"), minutes)
    return seen.withColumn("late", late).drop("mark")


def mark_duplicates(flagged: DataFrame, heavy: dict[str, list] | None = None, span: int = SPAN) -> DataFrame:
    """Add ``duplicate``: a copy of this event id was accepted earlier.

    A late copy is not remembered, so a later copy in time is still accepted.
    """
    known = Running("_known", "max", F.when(~F.col("late"), 1), before=True)
    seen = running(flagged, "seq", [known], ["event_id"], heavy, span)
    return seen.withColumn("duplicate", F.col("_known").isNotNull()).drop("_known")


def trace_visits(
    events: DataFrame,
    accepted: Column,
    heavy: dict[str, list] | None = None,
    span: int = SPAN,
    terminal: list[str] = TERMINAL_TYPES,
) -> DataFrame:
    """Add ``episode`` and ``live`` per visit.

    ``episode`` is the order of the last terminal event before the row (-2 for none),
    so it numbers the stays of a visit id. ``live`` says that an arrival opened the
    episode at or before the row.
    """
    ends = accepted & F.col("event_type").isin(terminal)
    opens = accepted & (F.col("event_type") == "ARRIVAL")
    seen = running(
        events,
        "seq",
        [
            Running("_ended", "max", F.when(ends, F.col("seq")), before=True),
            Running("_opened", "max", F.when(opens, F.col("seq"))),
        ],
        ["visit_id"],
        heavy,
        span,
    )
    episode = F.coalesce(F.col("_ended"), F.lit(FIRST_EPISODE))
    return (
        seen.withColumn("episode", episode.cast("long"))
        .withColumn("live", F.coalesce(F.col("_opened") > F.col("episode"), F.lit(False)))
        .drop("_ended", "_opened")
    )


def classify(
    events: DataFrame,
    minutes: int = WATERMARK_MINUTES,
    heavy: dict[str, list] | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Add ``outcome`` and ``episode`` to every event of one ordered list.

    A copy of an event id that carries another event time than the first one could raise
    the high-water mark. One aggregate per id looks for such ids; only if there are any,
    their copies are settled before the marks are taken.
    """
    heavy = heavy_keys(events, "event_id", "visit_id") if heavy is None else heavy
    times = events.groupBy("event_id").agg(F.min("event_ts").alias("_first"), F.max("event_ts").alias("_last"))
    disputed = times.filter("_first <> _last").select(F.col("event_id").alias("_id"))
    # Cutting heavy keys reads a step's input twice, so each step is then stored once.
    split = any(heavy.values())
    if disputed.isEmpty():
        late = mark_late(events, minutes, span)
    else:
        copies = settle(events, stage(disputed, "disputed"), minutes, heavy, span)
        ignored = copies.filter("duplicate").select(F.col("seq").alias("_seq"))
        marked = events.join(ignored, F.col("seq") == F.col("_seq"), "left").withColumn("_raises", F.col("_seq").isNull())
        late = mark_late(marked, minutes, span, F.col("_raises")).drop("_raises", "_seq")
    checked = stage_if(split, mark_duplicates(late, heavy, span), "checked")
    accepted = ~F.col("duplicate") & ~F.col("late")
    traced = trace_visits(checked, accepted, heavy, span)
    classified = traced.withColumn("outcome", outcome()).drop("duplicate", "late", "live")
    return stage_if(split, classified, "classified")


def settle(
    events: DataFrame, disputed: DataFrame, minutes: int, heavy: dict[str, list], span: int = SPAN, fold: int = FOLD
) -> DataFrame:
    """(seq, duplicate) of every copy of the ``disputed`` ids, whose copies differ in event time.

    A duplicate must not raise the high-water mark, but which rows are duplicates depends on
    the mark. All other ids raise it whatever their outcome, so one pass over the events
    leaves the disputed rows alone, each with the highest undisputed time before it
    (``base``). The rounds work on these rows only. A round bounds the mark of each row from
    below (rows that surely raise it) and above (rows that may) and decides what both bounds
    agree on; the first ``fold`` rows still open are then replayed one after another. So a
    round decides at least ``fold`` rows, in whatever way they hang on each other.
    """
    ids = disputed.count()
    side = F.broadcast(disputed) if ids <= BROADCAST_IDS else disputed
    tagged = events.select("seq", "event_id", "event_ts").join(side, F.col("event_id") == F.col("_id"), "left")
    plain = Running("base", "max", F.when(F.col("_id").isNull(), F.col("event_ts")), before=True)
    rows = running(tagged, "seq", [plain], span=span).filter(F.col("_id").isNotNull()).drop("_id")
    # ``dup`` and ``was_late`` are null while open; the first copy of an id is no duplicate.
    earlier = running(rows, "seq", [Running("_n", "sum", F.lit(1), before=True)], ["event_id"], heavy, span)
    unknown = F.lit(None).cast("boolean")
    first = F.coalesce(F.col("_n"), F.lit(0)) == 0
    rows = earlier.select(
        "seq", "event_id", "event_ts", "base", F.when(first, False).alias("dup"), unknown.alias("was_late")
    )
    rows = stage(rows, "settle")
    while True:
        rows = stage(_bounded(rows, minutes, heavy, span), "settle")
        open_rows = rows.filter("open")
        if open_rows.isEmpty():
            return rows.select("seq", F.col("dup").alias("duplicate"))
        replayed = _replay(open_rows, minutes, fold)
        rows = rows.join(F.broadcast(replayed), F.col("seq") == F.col("_seq"), "left").select(
            "seq", "event_id", "event_ts", "base", *[F.coalesce(f"_{c}", c).alias(c) for c in ("dup", "was_late")]
        )


def _bounded(rows: DataFrame, minutes: int, heavy: dict[str, list], span: int) -> DataFrame:
    """Decide what the bounds of the mark decide; ``open`` marks the rest.

    Adds ``at_least`` (the mark before the row without what is open) and ``known`` (an
    earlier copy was surely no late one), which a replay of the open rows starts from.
    """
    time = F.col("event_ts")
    raising = [
        Running("_low", "max", F.when(F.col("dup") == F.lit(False), time), before=True),
        Running("_high", "max", F.when(~F.coalesce("dup", F.lit(False)), time), before=True),
    ]
    seen = running(rows, "seq", raising, span=span)
    low, high = F.greatest("base", "_low"), F.greatest("base", "_high")
    surely = before_watermark(time, low, minutes)
    never = ~before_watermark(time, high, minutes)
    was_late = F.coalesce("was_late", F.when(surely, True).when(never, False))
    seen = seen.withColumns({"at_least": low, "was_late": was_late}).drop("_low", "_high")
    remembered = [
        Running("_sure", "max", F.when(F.col("was_late") == F.lit(False), 1), before=True),
        Running("_maybe", "max", F.when(~F.coalesce("was_late", F.lit(False)), 1), before=True),
    ]
    seen = running(seen, "seq", remembered, ["event_id"], heavy, span)
    known = F.col("_sure").isNotNull()
    dup = F.coalesce("dup", F.when(known, True).when(F.col("_maybe").isNull(), False))
    seen = seen.withColumns({"known": known, "dup": dup}).drop("_sure", "_maybe")
    # Whether a duplicate is late does not matter: its id is known already.
    return seen.withColumn("open", F.col("dup").isNull() | (~F.col("dup") & F.col("was_late").isNull()))


def _replay(open_rows: DataFrame, minutes: int, fold: int) -> DataFrame:
    """(_seq, _dup, _was_late) of the first ``fold`` open rows, replayed in order as one array."""
    block = open_rows.orderBy("seq").limit(fold)
    here = Window.partitionBy(F.lit(0)).orderBy("seq")
    block = block.withColumn("_at", F.row_number().over(here) - 1)
    block = block.withColumn("_copy", F.lag("_at").over(Window.partitionBy("event_id").orderBy("seq")))
    row = F.struct("seq", "event_ts", "at_least", "known", "_copy")
    rows = block.agg(F.sort_array(F.collect_list(row)).alias("rows"))
    code = F.array().cast("array<int>")  # per row: 1 late, 2 duplicate, 4 id known afterwards
    start = F.struct(F.lit(None).cast("timestamp").alias("mark"), code.alias("codes"))

    def step(state: Column, row: Column) -> Column:
        mark = F.greatest(state["mark"], row["at_least"])
        copy = F.coalesce(F.get(state["codes"], row["_copy"]), F.lit(0))
        dup = row["known"] | (copy >= 4)
        late = before_watermark(row["event_ts"], mark, minutes)
        codes = late.cast("int") + dup.cast("int") * 2 + (dup | ~late).cast("int") * 4
        # A late row lies below the mark and cannot raise it.
        raised = F.when(dup, state["mark"]).otherwise(F.greatest(state["mark"], row["event_ts"]))
        return F.struct(raised.alias("mark"), F.array_append(state["codes"], codes).alias("codes"))

    codes = F.aggregate("rows", start, step, lambda state: state["codes"])
    done = rows.select(F.inline(F.arrays_zip(F.col("rows.seq").alias("_seq"), codes.alias("code"))))
    return done.select(
        "_seq",
        (F.col("code").bitwiseAND(2) > 0).alias("_dup"),
        (F.col("code").bitwiseAND(1) > 0).alias("_was_late"),
    )


def outcome() -> Column:
    return (
        F.when(F.col("duplicate"), DUPLICATE)
        .when(F.col("late"), LATE)
        .when(~F.col("live"), ORPHAN)
        .otherwise(ACCEPTED)
    )


def stream_counters(ledger: DataFrame) -> DataFrame:
    """One-row quality counters of a ledger with ``outcome`` and ``errors``.

    Orphans count as processed and as rejected; duplicates are neither.
    """
    kind = F.col("outcome")
    missing = F.exists("errors", lambda e: e.startswith("MISSING_"))

    def count(condition: Column) -> Column:
        return F.count_if(condition).cast("long")

    return ledger.agg(
        count(kind.isin(ACCEPTED, ORPHAN)).alias("records_processed"),
        count(kind.isin(INVALID, LATE, ORPHAN)).alias("records_rejected"),
        count(kind == DUPLICATE).alias("duplicate_event_ids"),
        count(F.array_contains("errors", "MALFORMED_JSON")).alias("malformed_events"),
        count(kind == LATE).alias("late_events"),
        count((kind == INVALID) & missing).alias("missing_fields"),
    )


def quarantine(ledger: DataFrame) -> DataFrame:
    """Rejected rows with their errors; duplicates are ignored, not quarantined."""
    kind = F.col("outcome")
    return ledger.filter(kind.isin(INVALID, LATE, ORPHAN)).withColumn(
        "errors", F.when(kind == INVALID, F.col("errors")).otherwise(F.array(kind))
    )


def ledger(
    parsed: DataFrame,
    minutes: int = WATERMARK_MINUTES,
    heavy: dict[str, list] | None = None,
    span: int = SPAN,
) -> DataFrame:
    """Outcome of every parsed row, the contract violations included."""
    broken = F.size("errors") > 0
    valid = classify(parsed.filter(~broken), minutes, heavy, span)
    invalid = (
        parsed.filter(broken)
        .withColumn("episode", F.lit(None).cast("long"))
        .withColumn("outcome", F.lit(INVALID))
    )
    return valid.unionByName(invalid)
