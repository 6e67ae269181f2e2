"""Keyed messages (Kafka wire format) and the stream sources.

A message has key = ``business_id`` and value = the review as JSON, so a
keyed topic keeps one business in one partition. The Kafka connector jar is
not bundled; ``read_review_stream(source="kafka")`` needs it on the cluster's
classpath. The file source replays JSON-lines files as a stream for tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIRE_FIELDS = ("review_id", "user_id", "business_id", "stars", "text", "date",
               "useful", "funny", "cool", "is_injected")


def review_wire(reviews: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Reviews in wire shape: ``date`` as 'yyyy-MM-dd HH:mm:ss' text (UTC)."""
    cols = [c for c in WIRE_FIELDS if c in reviews.columns and c != "date"]
    return reviews.select(*cols, F.date_format(time_col, "yyyy-MM-dd HH:mm:ss").alias("date"))


def to_keyed_messages(reviews: DataFrame, fields: tuple[str, ...] | None = None) -> DataFrame:
    """``(key STRING, value STRING)``; NULL fields are left out of the JSON."""
    cols = list(fields) if fields else reviews.columns
    return reviews.select(F.col("business_id").cast("string").alias("key"),
                          F.to_json(F.struct(*cols)).alias("value"))


def kafka_sink_options(bootstrap: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def kafka_source_options(bootstrap: str, topic: str, starting_offsets: str = "latest",
                         fail_on_data_loss: bool = False) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower()}


def write_kafka(messages: DataFrame, bootstrap: str, topic: str) -> None:
    """Batch write of keyed messages to Kafka (needs the Kafka connector)."""
    messages.write.format("kafka").options(**kafka_sink_options(bootstrap, topic)).save()


def start_kafka_stream(messages: DataFrame, bootstrap: str, topic: str, checkpoint: str):
    """Streaming write of keyed messages to Kafka (needs the Kafka connector)."""
    return (messages.writeStream.format("kafka").options(**kafka_sink_options(bootstrap, topic))
            .option("checkpointLocation", checkpoint).outputMode("append").start())


def read_review_stream(spark: SparkSession, source: str = "files", path: str | None = None,
                       bootstrap: str | None = None, topic: str | None = None,
                       starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` lines: Kafka topic or a folder of JSON-lines files."""
    if source == "kafka":
        return (spark.readStream.format("kafka")
                .options(**kafka_source_options(bootstrap, topic, starting_offsets, fail_on_data_loss)).load()
                .select(F.col("key"), F.col("value")))
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
