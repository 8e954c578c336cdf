"""Messages to Bronze: one row per quote, every message kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.columns import optional_column, stamp
from quotelake.schema import (
    BRONZE_META, CORRUPT_RECORD, NO_RESULT, PARSE_ERROR, PARSE_OK,
    PAYLOAD_SCHEMA, QUOTE_FIELDS,
)


def parse_status(payload: str) -> Column:
    """Status of a permissively parsed payload struct column."""
    results = F.col(f"{payload}.results")
    return (
        F.when(F.col(payload).isNull() | F.col(f"{payload}.{CORRUPT_RECORD}").isNotNull(),
               PARSE_ERROR)
        .when(results.isNull() | (F.size(results) == 0), NO_RESULT)
        .otherwise(PARSE_OK)
    )


def to_bronze(messages: DataFrame, clock: Column | None = None) -> DataFrame:
    """Kafka-shaped rows (``timestamp`` and ``value`` required) to Bronze.

    ``clock`` may use the Bronze metadata columns; it stamps ingest_time.
    """
    parsed = messages.select(
        optional_column(messages, "topic", "string").alias("topic"),
        optional_column(messages, "partition", "int").alias("partition"),
        optional_column(messages, "offset", "bigint").alias("offset"),
        optional_column(messages, "key", "string").alias("key"),
        F.col("timestamp").cast("timestamp").alias("kafka_time"),
        F.col("value").cast("string").alias("raw_json"),
    ).withColumn(
        "payload",
        F.from_json("raw_json", PAYLOAD_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}),
    ).withColumns({"parse_status": parse_status("payload"), "ingest_time": stamp(clock)})

    quotes = parsed.select(*BRONZE_META, F.explode_outer("payload.results").alias("quote"))
    return quotes.select(*BRONZE_META, *[f"quote.{field}" for field in QUOTE_FIELDS])
