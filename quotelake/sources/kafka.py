"""Kafka-shaped input and output; files stand in where no connector is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from quotelake.schema import MESSAGE_SCHEMA


def kafka_stream(spark: SparkSession, servers: str, topic: str, *,
                 starting: str = "earliest", max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """One topic from its earliest offsets.

    ``min_partitions`` splits large topic partitions over more tasks than the topic has
    partitions, ``max_offsets_per_trigger`` bounds a micro-batch after an outage.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": starting}
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return spark.readStream.format("kafka").options(**options).load()


def message_files_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Files of Kafka-shaped rows as a stream."""
    reader = spark.readStream.format(fmt).schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def publish_options(servers: str, topic: str) -> dict[str, str]:
    """Every replica in sync has to confirm a message; sends are retried."""
    return {"kafka.bootstrap.servers": servers, "topic": topic,
            "kafka.acks": "all", "kafka.retries": "5"}


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch: (key, value) rows to a topic."""
    messages.select("key", "value").write.format("kafka").options(
        **publish_options(servers, topic)).save()


def message_files_sink(path: str, topic: str, fmt: str = "parquet"):
    """A publisher of message files in the shape of Kafka records, where no broker is at hand:
    ``publish(messages, checkpoint)``. Offsets are left null; a broker gives them."""
    def publish(messages: DataFrame, checkpoint: str) -> DataStreamWriter:
        rows = messages.select(
            F.lit(topic).alias("topic"), F.lit(0).alias("partition"),
            F.lit(None).cast("bigint").alias("offset"), "key",
            F.current_timestamp().alias("timestamp"), "value")
        return (rows.writeStream.format(fmt).outputMode("append")
                .option("path", path).option("checkpointLocation", checkpoint))
    return publish


def topic_sink(servers: str, topic: str):
    """A publisher to a Kafka topic: ``publish(messages, checkpoint)``."""
    return lambda messages, checkpoint: publish_stream(messages, servers, topic, checkpoint)


def publish_stream(messages: DataFrame, servers: str, topic: str,
                   checkpoint: str) -> DataStreamWriter:
    """Stream: (key, value) rows to a topic; the caller sets the trigger and starts it."""
    return (
        messages.select("key", "value").writeStream.format("kafka")
        .options(**publish_options(servers, topic))
        .option("checkpointLocation", checkpoint).outputMode("append")
    )
