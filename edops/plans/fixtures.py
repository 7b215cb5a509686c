"""The driver's tables as emergency-department inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from edops.schemas import RECORD_WIDTH, SOURCE_SYSTEM, SOURCE_YEAR, SURVEY_LAYOUT

ORDER_SPAN = 1 << 25  # event order numbers are 256 apart
STAMP = "2024-02-01 00:00:00"

DISPOSITION_FLAGS = [
    "no_followup", "return_ed", "return_refer", "left_without_seen", "left_before_complete",
    "left_ama", "dead_on_arrival", "died_in_ed", "transfer_nursing", "transfer_psych",
    "transfer_other", "admit_hospital", "observation_hospitalized", "observation_discharged",
    "other_disposition",
]

# Survey texts that have the width of their field, whatever the order line holds.
_FULL = {
    "visit_month", "arrival_by_ambulance", "temperature_f", "heart_rate", "respiratory_rate", "systolic_bp",
    "diastolic_bp", "spo2", "triage_level", "pain_score", "hospital_code", "patient_code", "survey_year",
    *DISPOSITION_FLAGS,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table over all cores.

    A small file may be a single row group, hence a single task. A table that already
    has a partition per core stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed visits from the order lines; pairs of order and line give repeated ids."""
    part, order, supp = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")
    wait = F.when(
        F.col("l_tax") != 0, F.col("l_quantity").cast("int") * 3 + part % 7
    ).cast("double")
    return spread(table(spark, sf_dir, "lineitem")).select(
        F.concat(F.lit("V"), order, F.lit("-"), "l_linenumber").alias("visit_id"),
        F.nullif(F.col("l_linenumber") % 6, F.lit(0)).cast("int").alias("triage_level"),
        F.when(supp % 11 != 0, part % 130).cast("int").alias("age"),
        F.when(order % 13 != 0, order % 24).cast("int").alias("arrival_hour"),
        wait.alias("waiting_time_minutes"),
        (wait + order % 240).cast("double").alias("length_of_stay_minutes"),
        (F.col("l_returnflag") == "R").alias("admitted_flag"),
        (90 + part % 30).cast("double").alias("temperature"),
        (F.col("l_quantity") * 7).alias("heart_rate"),
        (5 + F.col("l_quantity")).alias("respiratory_rate"),
        (60 + part % 160).cast("double").alias("systolic_bp"),
        (40 + order % 120).cast("double").alias("diastolic_bp"),
        (45 + part % 60).cast("double").alias("spo2"),
        (F.col("l_linenumber") + supp % 6).cast("double").alias("pain_score"),
        record_order().alias("record_order"),
        F.when(part % 9 != 0, F.concat(F.substring(F.lit("abcdefGHIJ"), (part % 10 + 1).cast("int"), F.lit(1)), supp % 100)).alias(
            "diagnosis_code"
        ),
    )


def record_order() -> Column:
    """Whole-number order of the lines of one (order, line number) pair."""
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    return F.col("l_partkey") * F.lit(10**9) + cents


def record_texts() -> dict[str, Column]:
    """Text of each survey field that is set, from an order line."""
    part, order, supp = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")
    quantity = F.col("l_quantity").cast("int")
    missing = F.lit("-9")

    def zeros(value: Column, width: int) -> Column:
        return F.lpad(value.cast("string"), width, "0")

    wait = quantity * 3 + part % 7
    hour = F.when(order % 13 == 0, missing).otherwise(F.concat(zeros(order % 24, 2), F.lit("30")))
    out = {
        "visit_month": zeros(1 + order % 12, 2),
        "visit_weekday": (1 + order % 8).cast("string"),
        "arrival_time": hour,
        "waiting_time_minutes": F.when(F.col("l_tax") == 0, missing)
        .when(part % 41 == 0, F.lit("1.5"))
        .otherwise(zeros(wait, 4)),
        "length_of_stay_minutes": F.when(F.col("l_tax") == 0, missing).otherwise(
            zeros(wait + order % 240, 4)
        ),
        "age": F.when(supp % 11 == 0, missing).otherwise(zeros(part % 130, 3)),
        "sex": (1 + part % 3).cast("string"),
        "arrival_by_ambulance": zeros(1 + supp % 2, 2),
        "temperature_f": zeros(900 + part % 300, 4),
        "heart_rate": zeros(quantity * 7, 3),
        "respiratory_rate": zeros(5 + quantity, 3),
        "systolic_bp": zeros(60 + part % 160, 3),
        "diastolic_bp": zeros(40 + order % 120, 3),
        "spo2": zeros(45 + part % 60, 3),
        "triage_level": zeros(F.col("l_linenumber") % 7, 2),
        "pain_score": zeros(F.col("l_linenumber") + supp % 6, 2),
        "reason_for_visit_code": F.when(supp % 5 != 0, zeros(part % 100000, 5)).otherwise(F.lit("")),
        "diagnosis_code": F.when(part % 9 != 0, F.concat(F.lit("R"), zeros(supp % 1000, 3))).otherwise(F.lit("")),
        "hospital_code": zeros(supp % 1000, 3),
        "patient_code": zeros(part % 1000, 3),
        "survey_year": F.lit(str(SOURCE_YEAR)),
        "patient_weight": F.when(order % 29 == 0, F.lit("n/a"))
        .when(order % 31 == 0, F.lit("-1.5"))
        .otherwise(F.concat(zeros(part % 10000, 5), F.lit(".50000"))),
    }
    for i, name in enumerate(DISPOSITION_FLAGS):
        out[name] = F.when((order % 17 == i) | (part % 17 == i), F.lit("1")).otherwise(F.lit("0"))
    return out


def raw_record(texts: dict[str, Column]) -> Column:
    """Fixed-width record with each text right-aligned in its field; ``_FULL`` texts fill theirs."""
    pieces, position = [], 1
    for name, (start, width) in sorted(SURVEY_LAYOUT.items(), key=lambda item: item[1]):
        if start > position:
            pieces.append(F.lit(" " * (start - position)))
        pieces.append(texts[name] if name in _FULL else F.lpad(texts[name], width, " "))
        position = start + width
    pieces.append(F.lit(" " * (RECORD_WIDTH - position + 1)))
    return F.concat(*pieces)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze survey rows. Lines of one pair share a row number, hence a visit id."""
    return spread(table(spark, sf_dir, "lineitem")).select(
        raw_record(record_texts()).alias("raw_record"),
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(SOURCE_YEAR).alias("source_year"),
        F.lit("ed2022").alias("source_filename"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_row_number"),
        F.lit(STAMP).cast("timestamp").alias("ingestion_timestamp"),
        record_order().alias("record_order"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed patient events with a shuffled processing order and replayed copies."""
    kind, k = F.col("event_type"), F.col("_k")
    user, number = F.col("user_id"), F.col("event_id")
    label = (
        F.when(kind == "signup", "ARRIVAL")
        .when(kind == "error", "TRIAGE")
        .when(kind == "click", "VITALS_UPDATE")
        .when(kind == "view", "STATUS_UPDATE")
        .when(k < 25, "ADMISSION")
        .otherwise("DISCHARGE")
    )
    copies = F.when(number % 20 == 0, F.array(F.lit(0), F.lit(200))).otherwise(F.array(F.lit(0)))
    # Below the copies, so that the text is searched once a row and not for every column.
    found = table(spark, sf_dir, "events").withColumn("_k", F.regexp_extract("props", r"(\d+)", 1).cast("int"))
    rows = found.withColumn("delay", F.explode(copies))
    offset = (number * 7919) % 50 + F.col("delay")
    clicked = kind == "click"
    return rows.select(
        F.concat(F.lit("E"), number).alias("event_id"),
        label.alias("event_type"),
        F.lit(1).alias("event_version"),
        F.concat(F.lit("P"), user).alias("patient_id"),
        F.concat(F.lit("V"), user).alias("visit_id"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.when(kind == "error", 1 + k % 5).cast("int").alias("triage_level"),
        F.when(kind == "signup", (user * 37) % 95).cast("int").alias("age"),
        F.when(kind == "signup", F.when(user % 2 == 0, "F").otherwise("M")).alias("sex"),
        F.when(clicked, F.rint("value")).alias("heart_rate"),
        F.lit(None).cast("double").alias("respiratory_rate"),
        F.when(clicked & (k % 2 == 0), 70 + k % 150).cast("double").alias("systolic_bp"),
        F.lit(None).cast("double").alias("diastolic_bp"),
        F.when(clicked & (k % 3 == 0), 85 + k % 16).cast("double").alias("spo2"),
        F.lit(None).cast("double").alias("pain_score"),
        F.when(kind == "signup", "WAITING")
        .when(kind == "error", "TRIAGED")
        .when(kind == "view", "IN_TREATMENT")
        .alias("status"),
        # Order by (number + offset), then by number; both fit one whole number.
        ((number + offset) * 256 + (255 - offset)).alias("seq"),
        number.alias("number"),
        # Order by event time: numbers rise with time, a copy follows its original.
        (number * 2 + F.when(F.col("delay") > 0, 1).otherwise(0)).alias("time_seq"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as JSON text, some of them broken, as (raw_value, seq, number)."""
    number = F.col("number")
    time = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    damaged = {
        "visit_id": F.when(number % 89 != 0, F.col("visit_id")),
        "event_version": F.when(number % 83 == 0, 2).otherwise(F.col("event_version")),
        "triage_level": F.when(number % 79 == 0, 9).otherwise(F.col("triage_level")),
        "event_time": F.when(number % 73 == 0, F.lit("garbage")).otherwise(time),
        "event_type": F.when(number % 71 == 0, F.lit("UNKNOWN")).otherwise(F.col("event_type")),
    }
    source = spread(events(spark, sf_dir)).withColumn("event_time", F.lit(None).cast("string"))
    kept = [c for c in source.columns if c not in ("event_ts", "seq", "number", "time_seq")]
    text = F.to_json(F.struct(*[damaged.get(c, F.col(c)).alias(c) for c in kept]))
    return source.select(
        F.when(number % 97 == 0, F.lit("{bad")).otherwise(text).alias("raw_value"),
        "seq",
        "number",
        "time_seq",
    )


def event_slices(spark: SparkSession, sf_dir: str, folder: str, slices: int = 3, files: int = 2) -> str:
    """The raw events as text files, one write per slice of the event-time order.

    Every file of a slice is older than the files of the next one, so a file stream
    that takes ``files`` files per trigger reads one slice per micro-batch.
    """
    raw = raw_events(spark, sf_dir)
    top = raw.agg(F.max("time_seq")).first()[0] + 1
    for i in range(slices):
        low, high = top * i // slices, top * (i + 1) // slices
        part = raw.filter((F.col("time_seq") >= low) & (F.col("time_seq") < high))
        part.select("raw_value").repartition(files).write.mode("append").text(folder)
    return folder


def clinical(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three clinical extracts; free text holds commas, quotes and line breaks."""
    orders = spread(table(spark, sf_dir, "orders"))
    lines = spread(table(spark, sf_dir, "lineitem"))
    subject, stay = F.col("o_custkey"), F.col("o_orderkey")
    when = F.col("o_orderdate").cast("timestamp")
    edstays = orders.select(
        subject.alias("subject_id"),
        F.when(stay % 3 == 0, stay + 200000).alias("hadm_id"),
        stay.alias("stay_id"),
        when.alias("intime"),
        F.timestamp_seconds(F.unix_seconds(when) + (stay % 600) * 60).alias("outtime"),
        F.when(subject % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(stay % 7 != 0, F.col("o_orderpriority")).alias("race"),
        F.lit("WALK IN").alias("arrival_transport"),
        F.when(F.col("o_orderstatus") == "F", "HOME").otherwise("ADMITTED").alias("disposition"),
    )
    triage = orders.select(
        subject.alias("subject_id"),
        stay.alias("stay_id"),
        (F.lit(97.0) + (stay % 40) / F.lit(8.0)).alias("temperature"),
        (50 + stay % 90).cast("double").alias("heartrate"),
        (10 + stay % 20).cast("double").alias("resprate"),
        F.when(stay % 10 != 0, 85 + stay % 16).cast("double").alias("o2sat"),
        (90 + stay % 90).cast("double").alias("sbp"),
        (50 + stay % 50).cast("double").alias("dbp"),
        (stay % 11).cast("string").alias("pain"),
        (1 + stay % 5).cast("double").alias("acuity"),
        F.when(stay % 4 == 0, F.lit("Headache, mild"))
        .when(stay % 4 == 1, F.lit('Says "dizzy"'))
        .when(stay % 4 == 2, F.lit("Fall\nand bruise"))
        .alias("chiefcomplaint"),
    )
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    vitalsign = lines.select(
        F.col("l_suppkey").alias("subject_id"),
        order.alias("stay_id"),
        F.timestamp_seconds(F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + line * 60).alias(
            "charttime"
        ),
        (F.lit(97.0) + (order % 40) / F.lit(8.0)).alias("temperature"),
        (40 + F.col("l_quantity")).alias("heartrate"),
        (10 + line).cast("double").alias("resprate"),
        F.when(order % 9 != 0, 85 + order % 16).cast("double").alias("o2sat"),
        (90 + F.col("l_partkey") % 90).cast("double").alias("sbp"),
        (50 + F.col("l_partkey") % 50).cast("double").alias("dbp"),
        F.when(line % 2 == 0, F.lit("Sinus, regular")).alias("rhythm"),
        (line % 11).cast("string").alias("pain"),
    )
    return {"edstays": edstays, "triage": triage, "vitalsign": vitalsign}
