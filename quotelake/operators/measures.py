"""Measures over finished tables: counts, throughput, latency, percentiles, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.columns import is_blank, percent, share
from quotelake.functions.times import event_time, minutes_between, seconds_between
from quotelake.schema import LATENCY_LIMIT_SECONDS, SOURCE_LAG_SECONDS

# Stage -> (clock it starts on, clock it ends on).
STAGES = {
    "source_to_kafka": ("quote_time", "kafka_time"),
    "kafka_to_bronze": ("kafka_time", "ingest_time"),
    "bronze_to_silver": ("ingest_time", "silver_time"),
    "kafka_to_silver": ("kafka_time", "silver_time"),
    "source_to_silver": ("quote_time", "silver_time"),
}
CLOCKS = ("quote_time", "kafka_time", "ingest_time", "silver_time")
PERCENTILES = {"p50": 50, "p95": 95, "p99": 99}
STRIP = 3600


def _rows(name: str = "rows") -> Column:
    return F.count(F.lit(1)).alias(name)


def stage_seconds(stage: str) -> Column:
    return seconds_between(*STAGES[stage])


def all_present(columns: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def throughput(silver: DataFrame, time_col: str = "ingest_time") -> DataFrame:
    """Rows and rows per second for each minute, newest first."""
    return (
        silver.groupBy(F.date_trunc("minute", time_col).alias("minute"))
        .agg(_rows())
        .withColumn("rows_per_second", F.round(F.col("rows").cast("double") / 60.0, 2))
        .orderBy(F.desc("minute"))
    )


def price_summary(silver: DataFrame) -> DataFrame:
    """Samples, mean, extremes and spread of the price per symbol."""
    return (
        silver.groupBy("symbol")
        .agg(
            _rows("samples"),
            F.round(F.avg("price"), 2).alias("avg_price"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
            F.round(F.max("price") - F.min("price"), 2).alias("price_spread"),
        )
        .orderBy(F.desc("samples"), "symbol")
    )


def bronze_quality(bronze: DataFrame) -> DataFrame:
    """One row: how many Bronze rows meet each requirement."""
    return bronze.agg(
        _rows(),
        F.count_if(~is_blank(F.col("symbol"))).alias("with_symbol"),
        F.count_if(F.col("regularMarketPrice") > 0).alias("with_valid_price"),
        F.count_if(event_time(F.col("regularMarketTime")).isNotNull())
        .alias("with_valid_quote_time"),
        F.count_if(F.col("ingest_time").isNotNull()).alias("with_ingest_time"),
    )


def silver_residue(silver: DataFrame, stamp_col: str = "ingest_time") -> DataFrame:
    """One row: Silver rows that still break a rule; every count should be 0."""
    return silver.agg(_rows(), *residue_counts(stamp_col))


def residue_counts(stamp_col: str) -> list[Column]:
    return [
        F.count_if(is_blank(F.col("symbol"))).alias("invalid_symbols"),
        F.count_if(F.col("price").isNull() | (F.col("price") <= 0)).alias("invalid_prices"),
        F.count_if(F.col("quote_time").isNull()).alias("invalid_quote_times"),
        F.count_if(F.col(stamp_col).isNull()).alias("invalid_stamps"),
    ]


def reject_counts(quarantine: DataFrame) -> DataFrame:
    """Rows per combination of reasons, most frequent first."""
    return (
        quarantine.groupBy("rejection_reason").agg(_rows())
        .orderBy(F.desc("rows"), "rejection_reason")
    )


def repeated_quotes(bronze: DataFrame) -> DataFrame:
    """Bronze quotes seen more than once with the same symbol, time text and price."""
    return (
        bronze.select("symbol", F.col("regularMarketTime").alias("quote_time_raw"),
                      F.col("regularMarketPrice").alias("price"))
        .filter(all_present(["symbol", "quote_time_raw", "price"]))
        .groupBy("symbol", "quote_time_raw", "price").agg(_rows("occurrences"))
        .filter(F.col("occurrences") > 1)
        .orderBy(F.desc("occurrences"), "symbol", "quote_time_raw", "price")
    )


def observed_span(silver: DataFrame) -> DataFrame:
    """One row: first and last ingestion and the time between them."""
    return silver.agg(
        F.min("ingest_time").alias("first_ingest"), F.max("ingest_time").alias("last_ingest"),
    ).withColumns({
        "span_seconds": seconds_between("first_ingest", "last_ingest"),
        "span_minutes": minutes_between("first_ingest", "last_ingest"),
    })


def stage_latency(silver: DataFrame, extremes: bool = True) -> DataFrame:
    """Mean seconds per stage and symbol, slowest Kafka-to-Silver mean first."""
    means = [F.round(F.avg(stage_seconds(stage)), 2).alias(f"avg_{stage}_s")
             for stage in STAGES]
    bounds = [
        F.min(stage_seconds("kafka_to_silver")).alias("min_kafka_to_silver_s"),
        F.max(stage_seconds("kafka_to_silver")).alias("max_kafka_to_silver_s"),
    ] if extremes else []
    return (
        silver.filter(all_present(CLOCKS)).groupBy("symbol")
        .agg(_rows("samples"), *means, *bounds)
        .orderBy(F.desc("avg_kafka_to_silver_s"), "symbol")
    )


def recent_latency(silver: DataFrame, order_by: str = "ingest_time",
                   limit: int = 20) -> DataFrame:
    """The newest rows with their five stage times."""
    return (
        silver.filter(all_present(CLOCKS))
        .orderBy(F.desc(order_by), "symbol", "quote_time", "price")
        .limit(limit)
        .select("symbol", "price", *CLOCKS,
                *[stage_seconds(stage).alias(f"{stage}_s") for stage in STAGES])
    )


def partition_rows(silver: DataFrame) -> DataFrame:
    """Rows per Silver partition."""
    return (
        silver.groupBy("symbol", "trade_date").agg(_rows())
        .orderBy("symbol", "trade_date")
    )


def seconds_counts(df: DataFrame, value: Column, keys: Sequence[str]) -> DataFrame:
    """Rows (``n``) per keys and whole-second ``value``.

    The counts combine on the map side, so what is shuffled and sorted per key is the
    set of distinct seconds, never the rows.
    """
    return (
        df.select(*keys, value.alias("value")).filter(F.col("value").isNotNull())
        .groupBy(*keys, "value").agg(_rows("n"))
    )


def _histogram(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per (keys, value) with the running and the full count."""
    ordered = Window.partitionBy(*keys).orderBy("value")
    ends = Window.unboundedPreceding, Window.unboundedFollowing
    return counts.withColumns({
        "running": F.sum("n").over(ordered.rowsBetween(ends[0], Window.currentRow)),
        "total": F.sum("n").over(ordered.rowsBetween(*ends)),
    })


def _percentile(rank: int) -> Column:
    """Smallest value that at least ``rank`` percent of the rows do not exceed; exact."""
    return F.min(F.when(F.col("running") * 100 >= F.col("total") * rank, F.col("value")))


def latency_percentiles(silver: DataFrame, keys: Sequence[str] = ("symbol",),
                        ranks: Mapping[str, int] = PERCENTILES) -> DataFrame:
    """Exact percentiles of the Kafka-to-Silver seconds, with the number of rows."""
    return percentiles_of(seconds_counts(silver, stage_seconds("kafka_to_silver"), keys), keys, ranks)


def percentiles_of(counts: DataFrame, keys: Sequence[str] = ("symbol",),
                   ranks: Mapping[str, int] = PERCENTILES) -> DataFrame:
    """The same from rows counted per second."""
    if not keys:
        return _whole_percentiles(counts, ranks)
    result = (
        _histogram(counts, keys)
        .groupBy(*keys)
        .agg(*[_percentile(rank).alias(name) for name, rank in ranks.items()],
             F.sum("n").alias("samples"))
    )
    return result.orderBy(F.desc("p95"), *keys)


def _whole_percentiles(counts: DataFrame, ranks: Mapping[str, int]) -> DataFrame:
    """The same over all rows in one row, without all distinct seconds in one task.

    Counts per strip of ``STRIP`` seconds, of which there are few, tell in which strip each
    rank lies; seconds are counted out inside those strips only.
    """
    counts = counts.withColumn("strip", F.floor(F.col("value") / STRIP))
    before = Window.orderBy("strip").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    strips = counts.groupBy("strip").agg(F.sum("n").alias("held")).withColumns({
        "below": F.coalesce(F.sum("held").over(before), F.lit(0)), "total": F.sum("held").over(whole)})
    wanted = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(rank).alias("rank")) for name, rank in ranks.items()]))
    wanted = strips.withColumn("want", wanted).filter(
        (F.col("below") * 100 < F.col("total") * F.col("want.rank"))
        & ((F.col("below") + F.col("held")) * 100 >= F.col("total") * F.col("want.rank")))
    inner = Window.partitionBy("name").orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    inside = counts.join(wanted.select("strip", "below", "total", "want.*"), "strip").withColumn(
        "running", F.col("below") + F.sum("n").over(inner))
    found = inside.filter(F.col("running") * 100 >= F.col("total") * F.col("rank"))
    return found.agg(
        *[F.min(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in ranks],
        F.max("total").alias("samples"))


def source_lag(silver: DataFrame, limit_seconds: int = SOURCE_LAG_SECONDS) -> DataFrame:
    """Per symbol: rows the source delivered late, their share, and the p95 lag."""
    return (
        _histogram(seconds_counts(silver, stage_seconds("source_to_kafka"), ["symbol"]), ["symbol"])
        .groupBy("symbol")
        .agg(
            F.sum(F.when(F.col("value") > limit_seconds, F.col("n")).otherwise(0))
            .alias("late_samples"),
            F.sum("n").alias("samples"),
            _percentile(95).alias("p95_lag_s"),
        )
        .select("symbol", "late_samples",
                percent(F.col("late_samples"), F.col("samples")).alias("late_pct"),
                "p95_lag_s")
        .orderBy(F.desc("late_samples"), "symbol")
    )


def quality_scores(silver: DataFrame, keys: Sequence[str] = (),
                   limit_seconds: int = LATENCY_LIMIT_SECONDS) -> DataFrame:
    """Validity, completeness, freshness, change share and their overall score.

    Freshness is the share of rows whose Kafka-to-Silver time is within the limit; a
    negative time is not fresh. The overall score is the mean of the first three. One
    pass over the table; an empty table scores null.
    """
    return scores(silver.groupBy(*keys).agg(*score_counts(limit_seconds)), keys)


def score_counts(limit_seconds: int = LATENCY_LIMIT_SECONDS) -> list[Column]:
    """Aggregates over Silver rows that the scores are made from."""
    return [
        _rows(),
        F.count_if(F.col("symbol").isNotNull() & (F.col("price") > 0)).alias("valid"),
        F.count_if(F.col("market_cap") > 0).alias("complete"),
        F.count_if(stage_seconds("kafka_to_silver").between(0, limit_seconds)).alias("fresh"),
        F.count_if(F.col("change").isNotNull()).alias("changed"),
    ]


def scores(counted: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The scores of counted rows."""
    rows = F.col("rows")
    parts = [share(F.col(name), rows) for name in ("valid", "complete", "fresh")]
    return counted.select(
        *keys, "rows",
        percent(F.col("valid"), rows).alias("validity_pct"),
        percent(F.col("complete"), rows).alias("completeness_pct"),
        percent(F.col("fresh"), rows).alias("freshness_pct"),
        percent(F.col("changed"), rows).alias("change_pct"),
        F.round((parts[0] + parts[1] + parts[2]) / 3.0 * 100, 2).alias("overall_pct"),
    )


def messages_per_minute(silver: DataFrame) -> DataFrame:
    """Rows per (silver_time minute, symbol)."""
    return (
        silver.groupBy(F.date_trunc("minute", "silver_time").alias("minute"), "symbol")
        .agg(_rows()).orderBy("minute", "symbol")
    )


def ingest_latency_series(silver: DataFrame) -> DataFrame:
    """Mean quote-to-ingest seconds per (ingest_time minute, symbol)."""
    return (
        silver.groupBy(F.date_trunc("minute", "ingest_time").alias("minute"), "symbol")
        .agg(F.avg(seconds_between("quote_time", "ingest_time")).alias("avg_latency_s"))
        .orderBy("minute", "symbol")
    )


def with_recompute_age(gold: DataFrame) -> DataFrame:
    """Adds the seconds from window end to the last rewrite; this is no latency."""
    return gold.withColumn("recompute_age_s", seconds_between("window_end", "gold_time"))
