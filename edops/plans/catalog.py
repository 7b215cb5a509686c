"""Registered queries: one per operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edops.functions.numeric import code_number, real_number, scaled_number
from edops.functions.times import iso_utc
from edops.operators import bi, cohorts as co, context as cx, events as ev, quality as dq
from edops.operators import survey as sv, visits as vs
from edops.operators.contract import EVENT_COLUMNS, flatten_events, parse_events
from edops.operators.order_stats import LOWER_MIDDLE, UPPER_MIDDLE, nearest_rank, order_statistics
from edops.operators.running import heavy_keys
from edops.plans import clinical as cl, export as ex, fixtures as fx, historical, replay
from edops.schemas import (
    CLINICAL_COLUMNS, SEX_CODES, STORED_STATE, SURVEY_LAYOUT, WEEKDAY_CODES,
)
from edops.session import configure, fresh_path, stage
from edops.sources import releases, sinks
from edops.sources.clinical import clinical_schema, read_extract, source_report, validate_source
from edops.sources.event_stream import file_events
from edops.sources.files import read_head
from edops.sources.fixed_width import read_bronze
from edops.streaming.job import VisitStream

MINUTES = 180  # watermark of the replay queries
_RECORDS_PER_FILE = 50_000  # 120 MB of survey text
HALF_TIME = "2024-01-16 00:00:00"  # cuts the events into an earlier and a later batch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text and arrays as joined text, so results compare by value."""
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        column = F.col(f"`{f.name}`")
        if kind in ("timestamp", "timestamp_ntz"):
            column = iso_utc(column.cast("timestamp"))
        elif kind == "array<string>":
            column = F.array_join(column, "|")
        out.append(column.alias(f.name))
    return df.select(*out)


def query(name: str):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _plain(build(configure(spark), sf_dir))

        QUERIES[name] = run
        return build

    return add


def _stamp() -> Column:
    return F.lit(fx.STAMP).cast("timestamp")


# --- Survey records ---------------------------------------------------------------


def _bronze_folder(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "survey")
    # A record of 2.4 KB is mostly blanks, which lz4 writes and reads at a fraction of gzip's
    # CPU. A compressed file cannot be split, so each one holds as many records as fit a split
    # of plain text.
    raw = fx.records(spark, sf_dir).select("raw_record")
    raw.write.option("maxRecordsPerFile", _RECORDS_PER_FILE).text(path, compression="lz4")
    return path


@query("fixed_width_bronze")
def fixed_width_bronze(spark, sf_dir):
    rows = read_bronze(spark, _bronze_folder(spark, sf_dir))
    return rows.select("raw_record", "source_system", "source_year")


def _fields(spark, sf_dir):
    return sv.parse_fields(fx.records(spark, sf_dir))


@query("fixed_width_parse")
def fixed_width_parse(spark, sf_dir):
    rfv = F.col("reason_for_visit_code")
    return _fields(spark, sf_dir).select(
        "source_row_number",
        *[F.col(f).alias(f"text_{f}") for f in SURVEY_LAYOUT],
        sv.arrival_hour(F.col("arrival_time")).alias("arrival_hour"),
        F.when(rfv != "", F.concat(F.lit("RFV_CODE:"), rfv)).alias("chief_complaint"),
        F.nullif("diagnosis_code", F.lit("")).alias("diagnosis_code"),
    )


@query("parse_numeric_codes")
def parse_numeric_codes(spark, sf_dir):
    return _fields(spark, sf_dir).select(
        "source_row_number",
        code_number(F.col("age")).alias("age"),
        code_number(F.col("visit_month")).alias("visit_month"),
        scaled_number(F.col("temperature_f"), 10).alias("temperature"),
        scaled_number(F.col("waiting_time_minutes")).alias("waiting_time_minutes"),
        scaled_number(F.col("length_of_stay_minutes")).alias("length_of_stay_minutes"),
        real_number(F.col("patient_weight")).alias("source_weight"),
    )


@query("code_maps")
def code_maps(spark, sf_dir):
    return _fields(spark, sf_dir).select(
        "source_row_number",
        sv.code_label(F.col("sex"), SEX_CODES).alias("sex"),
        sv.code_label(F.col("visit_weekday"), WEEKDAY_CODES).alias("visit_weekday"),
        sv.weekend(F.col("visit_weekday")).cast("int").alias("weekend_flag"),
        sv.triage_code(F.col("triage_level")).alias("triage_level"),
    )


@query("disposition_precedence")
def disposition_precedence(spark, sf_dir):
    flags = {name: F.col(name) for name in SURVEY_LAYOUT}
    return (
        _fields(spark, sf_dir)
        .select(
            F.coalesce(sv.disposition(flags), F.lit("NONE")).alias("disposition"),
            sv.admitted(flags).cast("int").alias("admitted_flag"),
            "source_row_number",
        )
    )


@query("stable_ids")
def stable_ids(spark, sf_dir):
    record = sv.record_id(F.col("source_row_number"))
    return fx.records(spark, sf_dir).select(
        "source_row_number", record.alias("source_record_id"), sv.visit_id(record).alias("visit_id")
    )


@query("clean_visits")
def clean_visits(spark, sf_dir):
    out = historical.silver(fx.records(spark, sf_dir), "record_order")
    flags = [F.col(c).cast("int").alias(c) for c in ("weekend_flag", "admitted_flag")]
    return out.select(*[c for c in out.columns if c not in ("weekend_flag", "admitted_flag")], *flags)


# --- Quality of visits ----------------------------------------------------------------


@query("quality_flags")
def quality_flags(spark, sf_dir):
    rows = dq.add_quality(fx.visits(spark, sf_dir))
    return rows.select("visit_id", "record_order", "data_quality_flags", "data_quality_status")


def _marked(spark, sf_dir):
    return dq.mark_repeats(dq.add_quality(fx.visits(spark, sf_dir)), "visit_id", "record_order")


@query("duplicate_visits")
def duplicate_visits(spark, sf_dir):
    rows = _marked(spark, sf_dir).filter(F.col("occurrence") > 1)
    return rows.select("visit_id", "record_order", "occurrence", "data_quality_flags", "data_quality_status")


@query("dq_report")
def dq_report(spark, sf_dir):
    report = dq.quality_report(_marked(spark, sf_dir), _stamp())
    pairs = F.transform(
        F.map_entries("flag_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))
    )
    return report.withColumn("flag_counts", F.array_join(pairs, ";"))


@query("dq_flag_counts")
def dq_flag_counts(spark, sf_dir):
    return dq.flag_counts(_marked(spark, sf_dir))


# --- Cohorts ------------------------------------------------------------------------------


@query("age_band")
def age_band(spark, sf_dir):
    return fx.visits(spark, sf_dir).select(
        "visit_id", "record_order", "age", co.age_band(F.col("age")).alias("age_group")
    )


@query("diagnosis_group")
def diagnosis_group(spark, sf_dir):
    code = F.col("diagnosis_code")
    return fx.visits(spark, sf_dir).select(
        "visit_id", "record_order", sv.diagnosis_group(code).alias("diagnosis_group")
    )


def _cohorts(spark, sf_dir):
    return co.build_cohorts(fx.visits(spark, sf_dir))


@query("cohort_rollup")
def cohort_rollup(spark, sf_dir):
    return _cohorts(spark, sf_dir)


@query("nearest_rank_p90")
def nearest_rank_p90(spark, sf_dir):
    return _cohorts(spark, sf_dir).select("cohort_key", "p90_wait_minutes", "p90_los_minutes")


@query("order_statistics")
def price_statistics(spark, sf_dir):
    """Exact median ends and nearest-rank p90 of a real-valued measure."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    ranks = {"lower_median": LOWER_MIDDLE, "upper_median": UPPER_MIDDLE, "p90": nearest_rank(0.9)}
    return order_statistics(rows, ["l_returnflag", "l_linestatus"], "l_extendedprice", ranks)


# --- Event contract ---------------------------------------------------------------------


def _parsed(spark, sf_dir, *kept: str):
    raw = fx.raw_events(spark, sf_dir)
    return flatten_events(parse_events(raw), ("seq", "number", *kept))


@query("event_parse")
def event_parse(spark, sf_dir):
    return _parsed(spark, sf_dir).select("seq", *EVENT_COLUMNS, "event_ts")


@query("event_validation")
def event_validation(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "seq", "event_ts", "errors", (F.size("errors") == 0).cast("int").alias("valid")
    )


def _raw_ledger(spark, sf_dir, *kept: str):
    # The counters need no raw text, which is the widest column of all.
    return ev.ledger(stage(_parsed(spark, sf_dir, *kept), "parsed"), MINUTES, span=fx.ORDER_SPAN)


@query("quarantine")
def quarantine(spark, sf_dir):
    rows = ev.quarantine(_raw_ledger(spark, sf_dir, "raw_value"))
    # The rejected text itself: the id inside it, or the whole text if it is no JSON.
    inside = F.coalesce(F.get_json_object("raw_value", "$.event_id"), F.col("raw_value"))
    return rows.select("seq", "event_id", "errors", inside.alias("raw_event"))


@query("dq_streaming")
def dq_streaming(spark, sf_dir):
    return ev.stream_counters(_raw_ledger(spark, sf_dir))


@query("replay_evidence")
def replay_evidence(spark, sf_dir):
    return replay.evidence(stage(_parsed(spark, sf_dir), "parsed"), MINUTES, fx.ORDER_SPAN)


# --- Event outcomes and visit state ------------------------------------------------------


def _events(spark, sf_dir):
    return fx.events(spark, sf_dir)


def _classified(spark, sf_dir):
    return ev.classify(_events(spark, sf_dir), MINUTES, span=fx.ORDER_SPAN)


@query("late_events")
def late_events(spark, sf_dir):
    late = ev.mark_late(_events(spark, sf_dir), MINUTES, fx.ORDER_SPAN).filter("late")
    return late.select("seq", "event_id", "event_ts")


@query("dedupe_events")
def dedupe_events(spark, sf_dir):
    events = _events(spark, sf_dir)
    flagged = ev.mark_late(events, MINUTES, fx.ORDER_SPAN)
    unique = ev.mark_duplicates(flagged, heavy_keys(events, "event_id"), fx.ORDER_SPAN)
    return unique.filter("not duplicate and not late").select("seq", "event_id", "visit_id", "event_ts")


@query("orphan_events")
def orphan_events(spark, sf_dir):
    rows = _classified(spark, sf_dir).filter(F.col("outcome") == ev.ORPHAN)
    return rows.select("seq", "event_id", "visit_id", "event_type")


def _episodes(spark, sf_dir):
    return replay.episodes(_events(spark, sf_dir), MINUTES, span=fx.ORDER_SPAN)


@query("episodes")
def episodes(spark, sf_dir):
    out = _episodes(spark, sf_dir)
    return out.withColumn("completed", F.col("completed").cast("int"))


@query("completed_visits")
def completed_visits(spark, sf_dir):
    return vs.completed_visits(_episodes(spark, sf_dir))


def _active(spark, sf_dir):
    return replay.active_state(_events(spark, sf_dir), MINUTES, fx.ORDER_SPAN)


@query("active_state")
def active_state(spark, sf_dir):
    return _active(spark, sf_dir)


@query("event_log_append")
def event_log_append(spark, sf_dir):
    events = _events(spark, sf_dir).select("event_id", "visit_id", "event_type", "event_ts", "number")
    previous = events.filter(_early()).dropDuplicates(["event_id"])
    return replay.append_log(previous, events)


def _early() -> Column:
    return F.col("event_ts") < F.lit(HALF_TIME).cast("timestamp")


def _in_time_order(spark, sf_dir):
    return _events(spark, sf_dir).withColumn("seq", F.col("time_seq")).withColumn("late", F.lit(False))


@query("state_merge")
def state_merge(spark, sf_dir):
    """Two batches cut by event time, the second one continuing the stored state."""
    events = _in_time_order(spark, sf_dir)
    cut = _early()
    state = spark.createDataFrame([], STORED_STATE)
    for part in (events.filter(cut), events.filter(~cut)):
        heavy = heavy_keys(part, "event_id", "visit_id")
        checked = ev.mark_duplicates(part, heavy, fx.ORDER_SPAN)
        traced = stage(vs.trace_batch(state, checked, heavy, fx.ORDER_SPAN), "batch")
        merged = stage(vs.merge_state(state, traced, heavy, fx.ORDER_SPAN), "state")
        state = vs.open_visits(merged)
    return state


# --- Context and attention ------------------------------------------------------------------


def _states(spark, sf_dir):
    return stage(_active(spark, sf_dir), "states")


@query("cohort_fallback")
def cohort_fallback(spark, sf_dir):
    """Orders look up cohorts of visits that lack ages at level 5 and hours at level 4.

    Triage level 6 has no visits at all, so every level of the fallback is met.
    """
    visits = fx.visits(spark, sf_dir)
    level = F.coalesce("triage_level", F.lit(0))
    sparse = visits.withColumns(
        {"age": F.when(level != 5, F.col("age")), "arrival_hour": F.when(level != 4, F.col("arrival_hour"))}
    )
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    probes = fx.table(spark, sf_dir, "orders").select(
        order.alias("order_key"),
        (order % 7).cast("int").alias("triage_level"),
        F.when(customer % 10 != 0, (customer % 100).cast("int")).alias("age"),
        F.when(order % 5 != 0, (order % 24).cast("int")).alias("arrival_hour"),
    )
    rows = co.match_cohorts(
        probes, co.build_cohorts(sparse), F.col("triage_level"), F.col("age"), F.col("arrival_hour")
    )
    return rows.select(
        "order_key",
        F.col("cohort.cohort_key").alias("cohort_key"),
        F.col("cohort.match_level").alias("match_level"),
    )


@query("expected_wait")
def expected_wait(spark, sf_dir):
    visits = fx.visits(spark, sf_dir).select(
        "visit_id", "record_order", "triage_level", "age", "arrival_hour", "waiting_time_minutes"
    )
    rows = co.match_cohorts(
        visits, _cohorts(spark, sf_dir), F.col("triage_level"), F.col("age"), F.col("arrival_hour")
    )
    with_wait = rows.withColumn(
        "expected_wait_minutes",
        cx.expected_wait(F.col("cohort.median_wait_minutes"), F.col("cohort.avg_wait_minutes")),
    )
    compared = with_wait.withColumns(
        cx.wait_context(F.col("waiting_time_minutes"), F.col("expected_wait_minutes"))
    )
    return compared.select(
        "visit_id", "record_order", "expected_wait_minutes", "wait_vs_expected_minutes", "wait_ratio"
    )


def _enriched(spark, sf_dir):
    return replay.enriched_state(_states(spark, sf_dir), _events(spark, sf_dir), _cohorts(spark, sf_dir))


@query("current_ed_state")
def current_ed_state(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query("attention_score")
def attention_score(spark, sf_dir):
    return _enriched(spark, sf_dir).select("visit_id", "attention_score", "attention_level")


@query("attention_reasons")
def attention_reasons(spark, sf_dir):
    return _enriched(spark, sf_dir).select("visit_id", "attention_reason")


# --- Gold -----------------------------------------------------------------------------------


def _gold(spark, sf_dir):
    return replay.gold(_states(spark, sf_dir), _events(spark, sf_dir), _cohorts(spark, sf_dir))


@query("ed_kpis")
def ed_kpis(spark, sf_dir):
    return _gold(spark, sf_dir).ed_kpis


@query("ed_load_15min")
def ed_load_15min(spark, sf_dir):
    return _gold(spark, sf_dir).ed_load_15min


# --- BI -------------------------------------------------------------------------------------


def _reports(spark, sf_dir):
    # The check table reads the historical report twice, for its counts and for its time.
    report = stage(dq.quality_report(_marked(spark, sf_dir), _stamp()), "report")
    return report, ev.stream_counters(_raw_ledger(spark, sf_dir))


@query("bi_kpis")
def bi_kpis(spark, sf_dir):
    gold = _gold(spark, sf_dir)
    return bi.bi_kpis(gold.ed_kpis, gold.current_ed_state)


@query("bi_load_15min")
def bi_load_15min(spark, sf_dir):
    return bi.bi_load_15min(_gold(spark, sf_dir).ed_load_15min)


@query("bi_active_patients")
def bi_active_patients(spark, sf_dir):
    return bi.bi_active_patients(_enriched(spark, sf_dir))


@query("bi_historical_context")
def bi_historical_context(spark, sf_dir):
    return bi.bi_historical_context(_cohorts(spark, sf_dir))


@query("bi_data_quality")
def bi_data_quality(spark, sf_dir):
    return bi.bi_data_quality(*_reports(spark, sf_dir))


@query("attention_distribution")
def attention_distribution(spark, sf_dir):
    return bi.attention_distribution(_enriched(spark, sf_dir))


@query("match_level_distribution")
def match_level_distribution(spark, sf_dir):
    return bi.match_level_distribution(_enriched(spark, sf_dir))


@query("wait_vs_history")
def wait_vs_history(spark, sf_dir):
    return bi.wait_vs_history(_enriched(spark, sf_dir))


@query("wait_variance_category")
def wait_variance_category(spark, sf_dir):
    category = bi.wait_variance_category(F.col("wait_vs_expected_minutes"), F.col("wait_ratio"))
    return expected_wait(spark, sf_dir).select(
        "visit_id", "record_order", category.alias("wait_variance_category")
    )


@query("active_queue_topk")
def active_queue_topk(spark, sf_dir):
    return bi.top_of_queue(bi.bi_active_patients(_enriched(spark, sf_dir)), 10).select(
        "visit_id", "attention_score", "waiting_minutes", "attention_level", "attention_reason"
    )


@query("active_queue_filtered")
def active_queue_filtered(spark, sf_dir):
    rows = bi.queue(
        bi.bi_active_patients(_enriched(spark, sf_dir)),
        triage_levels=[1, 2, 3],
        attention_levels=["HIGH", "CRITICAL"],
        statuses=["IN_TREATMENT", "TRIAGED"],
    )
    return rows.select("visit_id", "triage_level", "attention_level", "current_status", "attention_score")


@query("distinct_visits")
def distinct_visits(spark, sf_dir):
    return bi.distinct_visits(_events(spark, sf_dir))


@query("load_rollup")
def load_rollup(spark, sf_dir):
    day = F.date_format("window_start", "yyyy-MM-dd")
    return bi.load_rollup(_gold(spark, sf_dir).ed_load_15min, day, "day")


# --- Exports and published tables -----------------------------------------------------------


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The five tables, each stored once."""
    cohorts = stage(_cohorts(spark, sf_dir), "cohorts")
    gold = replay.gold(_states(spark, sf_dir), _events(spark, sf_dir), cohorts)
    tables = ex.bi_tables(gold, cohorts, *_reports(spark, sf_dir))
    return {name: stage(df, name) for name, df in tables.items()}


@query("export_manifest")
def export_manifest(spark, sf_dir):
    return bi.manifest(_tables(spark, sf_dir))


@query("export_validation")
def export_validation(spark, sf_dir):
    _, checked = ex.export(spark, _tables(spark, sf_dir), fresh_path(spark, "export"))
    return checked.withColumn("counts_match", F.col("counts_match").cast("int"))


@query("publish_tables")
def publish_tables(spark, sf_dir):
    done = sinks.publish(_tables(spark, sf_dir), fresh_path(spark, "published"), apply=True)
    return done.select("table_name", "row_count", "stored_rows", F.col("matches").cast("int").alias("matches"))


@query("publish_release")
def publish_release(spark, sf_dir):
    """The five tables as one release, which readers see whole."""
    target = fresh_path(spark, "released")
    done = releases.publish_release(_tables(spark, sf_dir), target)
    shown = bi.manifest(releases.read_release(spark, target)).select("table_name", F.col("row_count").alias("shown_rows"))
    return done.join(shown, "table_name").select(
        "table_name", "row_count", "stored_rows", "shown_rows", F.col("matches").cast("int").alias("matches")
    )


@query("read_head")
def head_of_published(spark, sf_dir):
    target = fresh_path(spark, "published")
    active = bi.bi_active_patients(_enriched(spark, sf_dir))
    sinks.write_table(active, f"{target}/active_patients")
    return read_head(spark, f"{target}/active_patients", 1000, ["visit_id"]).select(
        "visit_id", "current_status", "attention_score"
    )


# --- Clinical extracts ------------------------------------------------------------------------


def _extract(spark, sf_dir, table: str, root: str | None = None) -> str:
    path = cl.source_path(root or fresh_path(spark, "clinical"), table)
    (
        fx.clinical(spark, sf_dir)[table]
        .write.options(header=True, compression="gzip", escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )
    return path


def _csv_bronze(table: str):
    def run(spark, sf_dir):
        return read_extract(spark, _extract(spark, sf_dir, table), clinical_schema(table))

    return run


for _table in CLINICAL_COLUMNS:
    query(f"csv_bronze_{_table}")(_csv_bronze(_table))


def _extracts(spark, sf_dir) -> str:
    root = fresh_path(spark, "clinical")
    for table in CLINICAL_COLUMNS:
        _extract(spark, sf_dir, table, root)
    return root


@query("source_validation")
def source_validation(spark, sf_dir):
    root = _extracts(spark, sf_dir)
    reports = [validate_source(spark, cl.source_path(root, t), t) for t in CLINICAL_COLUMNS]
    return _per_table(reports)


@query("source_manifest")
def source_manifest(spark, sf_dir):
    root = _extracts(spark, sf_dir)
    reports = [source_report(spark, cl.source_path(root, t), t) for t in CLINICAL_COLUMNS]
    # File sizes and hashes depend on how the extract was split; their form does not.
    whole = [
        r.withColumn("row_count", F.when(F.length("sha256") == 64, F.col("row_count")))
        .filter(F.col("size_bytes") > 0)
        for r in reports
    ]
    return _per_table(whole)


def _per_table(reports: list[DataFrame]) -> DataFrame:
    every = reports[0]
    for report in reports[1:]:
        every = every.unionByName(report)
    return every.groupBy("table_name").agg(
        F.sum("row_count").alias("row_count"),
        F.min(F.col("header_ok").cast("int")).alias("header_ok"),
    )


@query("load_plan")
def load_plan(spark, sf_dir):
    plan = cl.ingest(spark, _extracts(spark, sf_dir), "bronze")
    return plan


@query("load_reconciliation")
def load_reconciliation(spark, sf_dir):
    done = cl.ingest(spark, _extracts(spark, sf_dir), fresh_path(spark, "bronze"), apply=True)
    return done.select(
        "table_name", "columns", "row_count", "stored_rows", F.col("matches").cast("int").alias("matches")
    )


@query("run_metrics")
def run_metrics(spark, sf_dir):
    """The whole historical job from a text file; durations differ per run and are left out."""
    source = _bronze_folder(spark, sf_dir)
    done = historical.run(spark, source, fresh_path(spark, "historical"))
    return done["run_metrics"].select("component", "event", "records_processed", "records_rejected")


# --- Streams ------------------------------------------------------------------------------------

_FILES = 2  # text files per slice and per micro-batch


def _raw_stream(spark, sf_dir) -> DataFrame:
    folder = fx.event_slices(spark, sf_dir, fresh_path(spark, "raw_events"), files=_FILES)
    return file_events(spark, folder, _FILES)


def _run_state(spark, sf_dir) -> VisitStream:
    stream = VisitStream(spark, fresh_path(spark, "stream"), MINUTES)
    stream.start_state(_raw_stream(spark, sf_dir)).awaitTermination()
    return stream


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    """Raw stream, parsed and stored by a streaming query."""
    target = fresh_path(spark, "ingested")
    parsed = flatten_events(parse_events(_raw_stream(spark, sf_dir)))
    valid = parsed.filter(F.size("errors") == 0).drop("errors")
    (
        valid.writeStream.format("parquet")
        .option("path", f"{target}/events")
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(valid.schema).parquet(f"{target}/events").drop("event_time")


@query("stream_malformed")
def stream_malformed(spark, sf_dir):
    stream = VisitStream(spark, fresh_path(spark, "stream"), MINUTES)
    stream.start_malformed(_raw_stream(spark, sf_dir)).awaitTermination()
    return spark.read.schema("raw_value string").json(f"{stream.output}/malformed")


@query("stream_state")
def stream_state(spark, sf_dir):
    return _run_state(spark, sf_dir).open_visits()


@query("stream_load_15min")
def stream_load_15min(spark, sf_dir):
    return _run_state(spark, sf_dir).load_windows()


@query("stream_load_table")
def stream_load_table(spark, sf_dir):
    """The load query: a streaming aggregate whose changed windows replace stored ones."""
    stream = _run_state(spark, sf_dir)
    stream.start_load(files=1).awaitTermination()
    return stream.stored_load()


@query("state_restore")
def state_restore(spark, sf_dir):
    """Two batches; a new job object takes over between them and repeats nothing."""
    raw = fx.raw_events(spark, sf_dir).withColumn("ingest_ts", _stamp())
    output = fresh_path(spark, "stream")
    cut = raw.agg(F.max("time_seq")).scalar() / 2
    for batch_id, part in enumerate((F.col("time_seq") < cut, F.col("time_seq") >= cut)):
        stream = VisitStream(spark, output, MINUTES)
        stream.process(raw.filter(part).select("raw_value", "ingest_ts"), batch_id)
    return stream.open_visits()
