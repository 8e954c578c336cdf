"""The sections of the collection report over one Kafka-time window."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from quotelake.operators import measures, series
from quotelake.plans.window import ReportWindow, describe_window, local_today
from quotelake.schema import DEFAULT_TICKERS, GOLD_COLUMNS
from quotelake.sources.lake import Lake, catalog_lake

LAYERS = {
    "bronze": "Bronze", "silver": "Silver", "quarantine": "Silver rejected",
    "gold_operational": "Gold operational", "gold_financial": "Gold financial",
}


def windowed(lake: Lake, window: ReportWindow | None) -> Lake:
    """All five tables cut to the window: Kafka time, or window start for Gold."""
    if window is None:
        return lake
    cut = {
        layer: window.apply(getattr(lake, layer),
                            "window_start" if layer.startswith("gold") else "kafka_time")
        for layer in LAYERS
    }
    return replace(lake, **cut)


def overview(lake: Lake) -> DataFrame:
    """Rows per layer, in layer order."""
    counts = [
        getattr(lake, layer).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(place).alias("place"), F.lit(title).alias("layer"), "rows")
        for place, (layer, title) in enumerate(LAYERS.items(), start=1)
    ]
    total = counts[0]
    for count in counts[1:]:
        total = total.unionByName(count)
    return total.orderBy("place").select("layer", "rows")


def gold_rows(gold: DataFrame) -> DataFrame:
    """Gold rows, newest window first."""
    return gold.select(*GOLD_COLUMNS).orderBy(F.desc("window_start"), "symbol")


def sections(lake: Lake, window: ReportWindow,
             tickers: Sequence[str] = DEFAULT_TICKERS) -> dict[str, Callable[[], DataFrame]]:
    """Section title -> job, in report order. ``lake`` is cut to the window here."""
    cut = windowed(lake, window)
    return {
        "00 window": lambda: describe_window(lake.bronze, window, len(tickers)),
        "01 overview": lambda: overview(cut),
        "02 throughput": lambda: measures.throughput(cut.silver),
        "03 prices by symbol": lambda: measures.price_summary(cut.silver),
        "04a bronze quality": lambda: measures.bronze_quality(cut.bronze),
        "04b silver quality": lambda: measures.silver_residue(cut.silver),
        "04c rejected rows": lambda: measures.reject_counts(cut.quarantine),
        "04d repeated quotes": lambda: measures.repeated_quotes(cut.bronze),
        "05 observed span": lambda: measures.observed_span(cut.silver),
        "06 stage latency": lambda: measures.stage_latency(cut.silver),
        "07 recent samples": lambda: measures.recent_latency(cut.silver),
        "08 partitions": lambda: measures.partition_rows(cut.silver),
        "09 gold operational": lambda: measures.with_recompute_age(
            gold_rows(cut.gold_operational)),
        "10 gold financial": lambda: gold_rows(cut.gold_financial),
        "11 latency percentiles": lambda: measures.latency_percentiles(cut.silver),
        "12 source lag": lambda: measures.source_lag(cut.silver),
        "13 quality scores": lambda: measures.quality_scores(cut.silver, ["symbol"])
        .orderBy(F.desc("overall_pct"), "symbol"),
        "14 coverage": lambda: series.coverage(cut.bronze, tickers, window.expected_cycles),
        "15 gaps": lambda: series.message_gaps(cut.bronze),
    }


def report(lake: Lake, window: ReportWindow,
           tickers: Sequence[str] = DEFAULT_TICKERS) -> dict[str, DataFrame]:
    """All sections as lazy DataFrames, in report order."""
    return {title: job() for title, job in sections(lake, window, tickers).items()}


SILVER_REPORT_COLUMNS = (
    "kafka_time", "symbol", "price", "quote_time", "market_cap", "change", "trade_date",
    "ingest_time", "silver_time",
)


BRONZE_REPORT_COLUMNS = (
    "kafka_time", "symbol", "regularMarketPrice", "regularMarketTime", "ingest_time",
    "parse_status",
)


def export_report(spark: SparkSession, day: str | None, out: str, *, start: str = "09:45",
                  end: str = "18:00", prefix: str = "", fmt: str = "parquet",
                  tickers: Sequence[str] = DEFAULT_TICKERS) -> list[str]:
    """Write every section of one session as a dataset of its own; returns the titles.

    Without a day it is today's session, local time. Every row carries the window's label,
    and CSV files have headings. Needs all five tables registered and names any that is not.
    Ten sections read the session's Silver rows and four its Bronze rows, so those narrow
    slices are kept for the length of the export; lost blocks are read again.
    """
    window = ReportWindow.session(day or local_today(), start, end)
    lake = catalog_lake(spark, prefix)
    slices = {
        layer: window.apply(getattr(lake, layer), "kafka_time").select(*columns)
        .persist(StorageLevel.MEMORY_AND_DISK)
        for layer, columns in (("silver", SILVER_REPORT_COLUMNS), ("bronze", BRONZE_REPORT_COLUMNS))}
    try:
        parts = report(replace(lake, **slices), window, tickers)
        for title, frame in parts.items():
            labelled = frame.select(F.lit(window.label).alias("report_window"), "*")
            writer = labelled.write.format(fmt).mode("overwrite")
            if fmt == "csv":
                writer = writer.option("header", "true")
            writer.save(f"{out.rstrip('/')}/{title.replace(' ', '_')}")
    finally:
        for kept in slices.values():
            kept.unpersist()
    return list(parts)
