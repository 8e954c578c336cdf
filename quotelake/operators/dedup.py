"""Exact deduplication that stays even when one group of copies is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _LANE = "_rank", "_lane"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Batch: the first row of each key in ``order``.

    Spark prunes a ``row_number() = 1`` filter before the shuffle as well, so each map
    task sends at most one row per key, however many copies it holds.
    """
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def keep_earliest(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Stream: the first row of each key in ``order``, once the watermark has passed the
    event-time column in ``keys``; no copy can follow then. Copies combine on the map side,
    so one quote that makes up a third of all rows sends a row per task."""
    rest = [c for c in stream.columns if c not in keys]
    first = stream.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("row"))
    return first.select(*[c if c in keys else F.col(f"row.{c}").alias(c) for c in stream.columns])


def drop_copies(stream: DataFrame, keys: Sequence[str], lane: Column,
                lanes: int | None) -> DataFrame:
    """Stream: one row per key; the event-time column in ``keys`` bounds the state.

    Streaming deduplication has no map-side step, so the copies of one quote would all
    meet in one task. With ``lanes`` they are first reduced on (key, lane), spread over
    that many tasks, and at most ``lanes`` rows per key meet in the second step. The
    lane comes from the row itself, so a replayed batch takes the same lanes.
    """
    if lanes and lanes > 1:
        stream = (
            stream.withColumn(_LANE, F.pmod(lane, F.lit(lanes)).cast("int"))
            .dropDuplicates([*keys, _LANE])
            .drop(_LANE)
        )
    return stream.dropDuplicates(list(keys))
