"""The metric catalogue: report measures without a window, or over the last 24 hours."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators import measures, series
from quotelake.plans.report import gold_rows
from quotelake.plans.window import ReportWindow
from quotelake.schema import DEFAULT_TICKERS
from quotelake.sources.lake import Lake


def catalogue(lake: Lake, now: datetime,
              tickers: Sequence[str] = DEFAULT_TICKERS) -> dict[str, Callable[[], DataFrame]]:
    """Metric name -> job."""
    day = ReportWindow.last_day(now)
    # Up to now and later: a message stamped ahead of the clock counts as well.
    recent = lake.bronze.filter(F.col("kafka_time") >= F.lit(day.start))
    if "kafka_date" in recent.columns:
        recent = recent.filter(F.col("kafka_date") >= f"{day.start.astimezone(timezone.utc):%Y-%m-%d}")
    return {
        "bronze_quality": lambda: measures.bronze_quality(lake.bronze),
        "silver_quality": lambda: measures.silver_residue(lake.silver, "silver_time"),
        "silver_rejects": lambda: measures.reject_counts(lake.quarantine),
        "bronze_repeats": lambda: measures.repeated_quotes(lake.bronze),
        "stage_latency": lambda: measures.stage_latency(lake.silver, extremes=False),
        "latency_percentiles": lambda: measures.latency_percentiles(lake.silver).drop("samples"),
        "recent_latency": lambda: measures.recent_latency(lake.silver, "silver_time"),
        "gold_recompute": lambda: measures.with_recompute_age(
            lake.gold_operational.orderBy(F.desc("window_end"), "symbol").limit(10)
        ).select("symbol", "window_end", "time_basis", "gold_time", "recompute_age_s"),
        "gold_financial": lambda: gold_rows(lake.gold_financial).limit(10).drop("gold_time"),
        "silver_throughput": lambda: measures.throughput(lake.silver, "silver_time").limit(5),
        "coverage_24h": lambda: series.coverage(recent, tickers, day.expected_cycles)
        .select("symbol", "parse_ok_rows", "expected_cycles", "coverage_pct"),
        "gaps_24h": lambda: series.message_gaps(recent),
    }
