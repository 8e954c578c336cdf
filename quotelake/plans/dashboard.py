"""The dashboard panels over the whole Silver table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.columns import stamp
from quotelake.operators import measures, partials, series
from quotelake.schema import LATENCY_ALARM_SECONDS, LATENCY_LIMIT_SECONDS

# Score -> lowest yellow and lowest green value (one step means no yellow).
SCORE_STEPS = {
    "overall_pct": (80, 95),
    "validity_pct": (98, 98),
    "completeness_pct": (90, 90),
    "freshness_pct": (85, 85),
}


def score_band(score: Column, yellow: float, green: float) -> Column:
    """Higher is better."""
    return F.when(score >= green, "green").when(score >= yellow, "yellow").when(
        score.isNotNull(), "red")


def latency_band(seconds: Column) -> Column:
    """Lower is better."""
    return F.when(seconds >= LATENCY_ALARM_SECONDS, "red").when(
        seconds >= LATENCY_LIMIT_SECONDS, "yellow").when(seconds.isNotNull(), "green")


def score_panel(silver: DataFrame, score: str, clock: Column | None = None) -> DataFrame:
    """One row: time, the score and its band."""
    return measures.quality_scores(silver).select(
        stamp(clock).alias("time"), score,
        score_band(F.col(score), *SCORE_STEPS[score]).alias("band"))


def score_panels(silver: DataFrame, clock: Column | None = None) -> DataFrame:
    """All four scores with their bands from one pass."""
    return measures.quality_scores(silver).select(
        stamp(clock).alias("time"), *SCORE_STEPS,
        *[score_band(F.col(score), *steps).alias(f"{score[:-4]}_band")
          for score, steps in SCORE_STEPS.items()])


def latency_panel(silver: DataFrame) -> DataFrame:
    """One row: p50, p95 and p99 over all rows, with bands."""
    return measures.latency_percentiles(silver, keys=()).select(
        *measures.PERCENTILES,
        *[latency_band(F.col(p)).alias(f"{p}_band") for p in measures.PERCENTILES])


def kept_panels(kept: partials.Kept, clock: Column | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The panels, and the catalogue's measures of all of Silver, from partial aggregates."""
    def score(name: str) -> DataFrame:
        return partials.quality_scores(kept).select(
            stamp(clock).alias("time"), name, score_band(F.col(name), *SCORE_STEPS[name]).alias("band"))

    def latency() -> DataFrame:
        return partials.latency_percentiles(kept, ()).select(
            *measures.PERCENTILES,
            *[latency_band(F.col(p)).alias(f"{p}_band") for p in measures.PERCENTILES])

    return {
        "overall_score": lambda: score("overall_pct"),
        "validity": lambda: score("validity_pct"),
        "completeness": lambda: score("completeness_pct"),
        "freshness": lambda: score("freshness_pct"),
        "latency": latency,
        "messages_per_minute": lambda: partials.messages_per_minute(kept),
        "latest_quotes": lambda: partials.latest_quotes(kept),
        "latency_series": lambda: partials.ingest_latency_series(kept),
        "silver_quality": lambda: partials.silver_residue(kept),
        "stage_latency": lambda: partials.stage_latency(kept),
        "latency_percentiles": lambda: partials.latency_percentiles(kept).drop("samples"),
        "silver_throughput": lambda: partials.throughput(kept).limit(5),
    }


def panels(silver: DataFrame, clock: Column | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Panel name -> job."""
    return {
        "overall_score": lambda: score_panel(silver, "overall_pct", clock),
        "validity": lambda: score_panel(silver, "validity_pct", clock),
        "completeness": lambda: score_panel(silver, "completeness_pct", clock),
        "freshness": lambda: score_panel(silver, "freshness_pct", clock),
        "latency": lambda: latency_panel(silver),
        "messages_per_minute": lambda: measures.messages_per_minute(silver),
        "latest_quotes": lambda: series.latest_quotes(silver),
        "latency_series": lambda: measures.ingest_latency_series(silver),
    }
