"""Silver to Gold: price aggregates per symbol and tumbling window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.columns import stamp
from quotelake.schema import GOLD_COLUMNS


def price_windows(silver: DataFrame, time_col: str, *, window: str = "5 minutes",
                  watermark: str = "5 minutes", clock: Column | None = None) -> DataFrame:
    """Average, lowest and highest price and sample count per (window, symbol).

    Windows are half-open and aligned to the epoch. All four aggregates are combined
    on the map side, so a symbol that owns most rows still shuffles only one row per
    window and task.
    """
    ticks = silver.withWatermark(time_col, watermark) if silver.isStreaming else silver
    return (
        ticks.groupBy(F.window(time_col, window).alias("span"), "symbol")
        .agg(
            F.avg("price").alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.count("price").alias("samples"),
        )
        .select(
            F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"),
            "symbol", "avg_price", "min_price", "max_price", "samples",
            F.lit(time_col).alias("time_basis"))
        .withColumn("gold_time", stamp(clock))
        .select(*GOLD_COLUMNS)
    )


def to_gold_operational(silver: DataFrame, window: str = "5 minutes",
                        watermark: str = "5 minutes",
                        clock: Column | None = None) -> DataFrame:
    """Windows over the ingestion clock: how the flow itself behaves."""
    return price_windows(silver, "ingest_time", window=window, watermark=watermark, clock=clock)


def to_gold_financial(silver: DataFrame, window: str = "5 minutes",
                      watermark: str = "10 minutes",
                      clock: Column | None = None) -> DataFrame:
    """Windows over the quote clock: how the market moved."""
    return price_windows(silver, "quote_time", window=window, watermark=watermark, clock=clock)


to_gold = to_gold_operational
