"""Partial aggregates of Silver per day of its Kafka time, and the measures made from them.

A partial of some rows is an aggregate that two of which merge into the partial of all their
rows: counts and sums add up, and the newest quote is the newer of two. So each batch of
a stream adds its own to its days, and no measure below opens Silver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.times import local_clock, seconds_between
from quotelake.operators import measures
from quotelake.schema import LOCAL_ZONE
from quotelake.sources.snapshots import Shape

DAY = "kafka_date"
CLOCKS_COUNTED = ("silver_time", "ingest_time")


@dataclass(frozen=True)
class Partial:
    """One table of partials: its keys behind the day, and how rows of a key are merged."""

    name: str
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    newest: tuple[str, ...] = ()

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.keys, *self.sums, *self.newest, DAY)

    @property
    def shape(self) -> Shape:
        return Shape(DAY, (*self.keys, *self.sums, *self.newest, DAY), self.keys[0])

    def merged(self, parts: DataFrame, by: tuple[str, ...] | None = None) -> DataFrame:
        """Partials merged per key, or per the columns ``by``; none at all count as 0."""
        by = (*self.keys, DAY) if by is None else by
        zero = F.lit(0).cast("bigint")
        return parts.groupBy(*by).agg(
            *[F.coalesce(F.sum(c), zero).alias(c) for c in self.sums], *[F.max(c).alias(c) for c in self.newest])


_SCORES = ("rows", "valid", "complete", "fresh", "changed")
_RESIDUE = ("invalid_symbols", "invalid_prices", "invalid_quote_times", "invalid_stamps")
COUNTS = Partial("day_counts", ("symbol",), (*_SCORES, *_RESIDUE, "samples", *measures.STAGES), ("last",))
SECONDS = Partial("day_seconds", ("symbol", "value"), ("n",))
MINUTES = Partial("day_minutes", ("clock", "minute", "symbol"), ("rows", "lag", "lag_rows"))


def _dated(silver: DataFrame) -> DataFrame:
    return silver.withColumn(DAY, F.date_format("kafka_time", "yyyy-MM-dd"))


def day_counts(silver: DataFrame) -> DataFrame:
    """Counts, seconds per stage and the newest quote, per day and symbol."""
    timed = measures.all_present(measures.CLOCKS)
    return _dated(silver).groupBy("symbol", DAY).agg(
        *measures.score_counts(), *measures.residue_counts("silver_time"), F.count_if(timed).alias("samples"),
        *[F.coalesce(F.sum(F.when(timed, measures.stage_seconds(stage))), F.lit(0).cast("bigint")).alias(stage)
          for stage in measures.STAGES],
        F.max(F.struct("quote_time", "silver_time", "price")).alias("last")).select(*COUNTS.columns)


def day_seconds(silver: DataFrame) -> DataFrame:
    """Rows per day, symbol and whole second between Kafka and Silver."""
    return measures.seconds_counts(
        _dated(silver), measures.stage_seconds("kafka_to_silver"), ["symbol", DAY]).select(*SECONDS.columns)


def day_minutes(silver: DataFrame) -> DataFrame:
    """Rows per day, symbol and minute of two clocks, with the seconds from quote to that clock."""
    ticks = F.explode(F.array(*[F.struct(
        F.lit(clock).alias("clock"), F.date_trunc("minute", clock).alias("minute"),
        seconds_between("quote_time", clock).alias("lag")) for clock in CLOCKS_COUNTED]))
    return (_dated(silver).select("symbol", DAY, ticks.alias("tick")).select("symbol", DAY, "tick.*")
            .groupBy("clock", "minute", "symbol", DAY)
            .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("lag"), F.lit(0).cast("bigint")).alias("lag"),
                 F.count("lag").alias("lag_rows")).select(*MINUTES.columns))


PARTIALS: dict[Partial, Callable[[DataFrame], DataFrame]] = {
    COUNTS: day_counts, SECONDS: day_seconds, MINUTES: day_minutes}


@dataclass(frozen=True)
class Kept:
    """The three tables as DataFrames."""

    counts: DataFrame
    seconds: DataFrame
    minutes: DataFrame


def quality_scores(kept: Kept) -> DataFrame:
    return measures.scores(COUNTS.merged(kept.counts, ()))


def silver_residue(kept: Kept) -> DataFrame:
    return COUNTS.merged(kept.counts, ()).select("rows", *_RESIDUE)


def stage_latency(kept: Kept) -> DataFrame:
    """As ``measures.stage_latency`` without the extremes."""
    merged = COUNTS.merged(kept.counts, ("symbol",)).filter(F.col("samples") > 0)
    return merged.select("symbol", "samples", *[
        F.round(F.col(stage) / F.col("samples"), 2).alias(f"avg_{stage}_s") for stage in measures.STAGES],
    ).orderBy(F.desc("avg_kafka_to_silver_s"), "symbol")


def latency_percentiles(kept: Kept, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    return measures.percentiles_of(SECONDS.merged(kept.seconds, (*keys, "value")), keys)


def latest_quotes(kept: Kept, zone: str = LOCAL_ZONE) -> DataFrame:
    return COUNTS.merged(kept.counts, ("symbol",)).select(
        "symbol", "last.price", local_clock(F.col("last.quote_time"), zone).alias("last_update"))


def _of_clock(kept: Kept, clock: str, by: tuple[str, ...]) -> DataFrame:
    return MINUTES.merged(kept.minutes.filter(F.col("clock") == clock), by)


def messages_per_minute(kept: Kept) -> DataFrame:
    return _of_clock(kept, "silver_time", ("minute", "symbol")).select("minute", "symbol", "rows").orderBy(
        "minute", "symbol")


def throughput(kept: Kept) -> DataFrame:
    """As ``measures.throughput`` by the Silver clock."""
    return _of_clock(kept, "silver_time", ("minute",)).select(
        "minute", "rows", F.round(F.col("rows").cast("double") / 60.0, 2).alias("rows_per_second")).orderBy(
        F.desc("minute"))


def ingest_latency_series(kept: Kept) -> DataFrame:
    return _of_clock(kept, "ingest_time", ("minute", "symbol")).select(
        "minute", "symbol", F.try_divide("lag", "lag_rows").alias("avg_latency_s")).orderBy("minute", "symbol")

