"""Per-symbol time series: gaps, latest quote, expected coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.columns import percent
from quotelake.functions.times import local_clock, seconds_between
from quotelake.operators.dedup import keep_first
from quotelake.schema import GAP_SECONDS, LOCAL_ZONE, PARSE_OK


def message_gaps(bronze: DataFrame, longer_than: int = GAP_SECONDS,
                 limit: int | None = 200) -> DataFrame:
    """Pauses between consecutive messages of a symbol, longest first.

    A lag over all messages of a symbol would put that symbol into one task. Messages
    in one slot no wider than the threshold can not be that far apart, so a gap always
    runs from the last message of a slot to the first of the next slot in use: only
    the two ends of each slot, combined on the map side, are shuffled and sorted. What
    one symbol sends to the window is bounded by the time covered, not by its messages.
    """
    width = max(int(longer_than), 1)
    slots = (
        bronze.select("symbol", "kafka_time")
        .filter(F.col("symbol").isNotNull() & F.col("kafka_time").isNotNull())
        .groupBy("symbol", F.floor(F.unix_seconds("kafka_time") / width).alias("slot"))
        .agg(F.min("kafka_time").alias("current_message"),
             F.max("kafka_time").alias("slot_end"))
    )
    gaps = (
        slots.withColumn(
            "previous_message",
            F.lag("slot_end").over(Window.partitionBy("symbol").orderBy("slot")))
        .filter(F.col("previous_message").isNotNull())
        .select("symbol", "previous_message", "current_message",
                seconds_between("previous_message", "current_message").alias("gap_s"))
        .filter(F.col("gap_s") > longer_than)
        .orderBy(F.desc("gap_s"), "symbol", "current_message")
    )
    return gaps if limit is None else gaps.limit(limit)


def latest_quotes(silver: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """The newest quote of each symbol and its local time of day."""
    narrow = silver.select("symbol", "price", "quote_time", "silver_time")
    newest = keep_first(
        narrow, ["symbol"], [F.desc("quote_time"), F.desc("silver_time"), F.desc("price")])
    return newest.select(
        "symbol", "price", local_clock(F.col("quote_time"), zone).alias("last_update"))


def coverage(bronze: DataFrame, expected: Sequence[str], cycles: int) -> DataFrame:
    """Expected tickers against what arrived; absent ones show 0 and null.

    Rows are narrowed to the expected symbols before the aggregate, so its result has
    at most ``len(expected)`` rows and is safe to broadcast. Several quotes in one
    message or repeated messages can lift the share above 100.
    """
    tickers = list(dict.fromkeys(expected))
    if not tickers:
        raise ValueError("coverage needs at least one expected ticker")
    listed = F.array(*[F.lit(ticker) for ticker in tickers])
    wanted = bronze.sparkSession.range(1).select(F.explode(listed).alias("symbol"))
    received = (
        bronze.filter(F.col("symbol").isin(tickers)).groupBy("symbol").agg(
            F.count(F.lit(1)).alias("bronze_rows"),
            F.count_if(F.col("parse_status") == PARSE_OK).alias("parse_ok_rows"),
            F.min("kafka_time").alias("first_message"),
            F.max("kafka_time").alias("last_message"),
        )
    )
    parsed = F.coalesce("parse_ok_rows", F.lit(0))
    return (
        wanted.join(F.broadcast(received), "symbol", "left")
        .select(
            "symbol",
            F.coalesce("bronze_rows", F.lit(0)).alias("bronze_rows"),
            parsed.alias("parse_ok_rows"),
            F.lit(cycles).cast("bigint").alias("expected_cycles"),
            percent(parsed, F.lit(cycles)).alias("coverage_pct"),
            "first_message", "last_message",
        )
        .orderBy("symbol")
    )
