"""The Kafka source and sink, run against a data source with the same options that keeps topics in files."""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, SimpleDataSourceStreamReader, WriterCommitMessage

from edops.sources.event_stream import kafka_events, write_kafka
from edops.streaming.job import VisitStream

T0 = datetime(2026, 1, 1)
RECORD = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"


def topic_source():
    """Defined inside a function, so that the classes travel to the workers by value."""

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, options):
            self.folder = os.path.join(options["kafka.bootstrap.servers"], options["subscribe"])
            self.latest = options["startingOffsets"] == "latest"

        def names(self):
            return sorted(os.listdir(self.folder))

        def initialOffset(self):
            return {"at": len(self.names()) if self.latest else 0}

        def read(self, start):
            end = {"at": len(self.names())}
            return self.readBetweenOffsets(start, end), end

        def readBetweenOffsets(self, start, end):
            rows = []
            for at, name in list(enumerate(self.names()))[start["at"] : end["at"]]:
                with open(os.path.join(self.folder, name)) as file:
                    record = json.load(file)
                rows.append((record["key"].encode(), record["value"].encode(), "t", 0, at, datetime(2026, 1, 1), 0))
            return iter(rows)

    class Writer(DataSourceWriter):
        def __init__(self, options):
            if options["kafka.acks"] != "all":
                raise ValueError("records may be lost")
            self.folder = os.path.join(options["kafka.bootstrap.servers"], options["topic"])

        def write(self, rows):
            os.makedirs(self.folder, exist_ok=True)
            for row in rows:
                with open(os.path.join(self.folder, f"{json.loads(row.value)['event_id']}-{uuid.uuid4().hex}"), "w") as file:
                    json.dump({"key": row.key, "value": row.value}, file)
            return WriterCommitMessage()

    class Topics(DataSource):
        @classmethod
        def name(cls):
            return "topic_files"

        def schema(self):
            return RECORD

        def simpleStreamReader(self, schema):
            return Reader(self.options)

        def writer(self, schema, overwrite):
            return Writer(self.options)

    return Topics


@pytest.fixture
def topics(spark):
    spark.dataSource.register(topic_source())


def events(spark, *rows):
    shaped = [(e, kind, 1, f"P-{v}", v, (T0 + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%SZ"), level) for e, kind, v, m, level in rows]
    return spark.createDataFrame(
        shaped, "event_id string, event_type string, event_version int, patient_id string, visit_id string, event_time string, triage_level int"
    )


def test_events_written_to_a_topic_come_back_as_visits(spark, tmp_path, topics):
    broker = str(tmp_path / "broker")
    write_kafka(events(spark, ("a", "ARRIVAL", "V1", 0, None), ("b", "TRIAGE", "V1", 5, 2), ("c", "ARRIVAL", "V2", 6, None)), broker, "patients", connector="topic_files")
    raw = kafka_events(spark, broker, "patients", max_offsets_per_trigger=10, connector="topic_files")
    assert raw.isStreaming and raw.dtypes == [("raw_value", "string"), ("ingest_ts", "timestamp")]
    stream = VisitStream(spark, str(tmp_path / "lake"))
    stream.start_state(raw).awaitTermination()
    write_kafka(events(spark, ("d", "DISCHARGE", "V2", 20, None), ("a", "ARRIVAL", "V1", 0, None)), broker, "patients", connector="topic_files")
    again = VisitStream(spark, str(tmp_path / "lake"))  # goes on from the stored offsets
    again.start_state(kafka_events(spark, broker, "patients", connector="topic_files")).awaitTermination()
    shown = [(r["visit_id"], r["triage_level"]) for r in again.open_visits().collect()]
    assert shown == [("V1", 2)]
    outcomes = {r["outcome"]: r["count"] for r in again.ledger().groupBy("outcome").agg(F.count("*").alias("count")).collect()}
    assert outcomes["ACCEPTED"] == 4 and sum(outcomes.values()) == 5


def test_latest_offsets_leave_out_what_the_topic_holds(spark, tmp_path, topics):
    broker = str(tmp_path / "broker")
    write_kafka(events(spark, ("a", "ARRIVAL", "V1", 0, None)), broker, "patients", connector="topic_files")
    query = (
        kafka_events(spark, broker, "patients", "latest", connector="topic_files").writeStream.format("memory").queryName("late_start")
        .option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("late_start").count() == 0
