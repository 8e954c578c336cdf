"""Log files as lines, once or continuously."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quotelake.operators.logs import by_topic, parse_log_lines


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row (``value``) per line."""
    return spark.read.text(path)


def stream_log_lines(spark: SparkSession, path: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """The same for files that keep arriving."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def start_topic_tables(lines: DataFrame, out: str, checkpoint: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """Append the entries of known topics to one folder per topic."""
    writer = (
        by_topic(parse_log_lines(lines)).writeStream.format("parquet").outputMode("append")
        .partitionBy("log_topic").option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start(out)
