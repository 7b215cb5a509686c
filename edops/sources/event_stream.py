"""Event stream sources and the Kafka sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_events(
    spark: SparkSession,
    bootstrap: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    connector: str = "kafka",
) -> DataFrame:
    """Kafka topic as (raw_value, ingest_ts); ``connector`` names a data source with Kafka's options."""
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError("starting_offsets is earliest or latest")
    reader = (
        spark.readStream.format(connector)
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load().select(
        F.col("value").cast("string").alias("raw_value"), F.col("timestamp").alias("ingest_ts")
    )


def file_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Folder of JSON-line files as (raw_value, ingest_ts)."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
        .select(F.col("value").alias("raw_value"), F.current_timestamp().alias("ingest_ts"))
    )


def kafka_records(events: DataFrame) -> DataFrame:
    """Key = visit id, value = the event as JSON."""
    return events.select(
        F.col("visit_id").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def write_kafka(events: DataFrame, bootstrap: str, topic: str, connector: str = "kafka") -> None:
    (
        kafka_records(events)
        .write.format(connector)
        .mode("append")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )
