"""Optional columns, clocks and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def optional_column(df: DataFrame, name: str, data_type: str) -> Column:
    """The column cast to ``data_type``, or a typed null where the input lacks it."""
    source = F.col(name) if name in df.columns else F.lit(None)
    return source.cast(data_type)


def stamp(clock: Column | None) -> Column:
    """Processing time: the wall clock unless the caller brings its own column."""
    return F.current_timestamp() if clock is None else clock.cast("timestamp")


def is_blank(text: Column) -> Column:
    """Null or spaces only (tabs and the like count as text)."""
    return text.isNull() | (F.length(F.trim(text)) == 0)


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double; null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, two decimals; null for an empty whole."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 2)


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays where it is.

    Spark moves a filter below the columns it reads by repeating their expressions,
    which would parse and check every document again. Rows that pass through a
    generator are kept without that.
    """
    return df.select("*", F.explode(F.when(condition, F.array(F.lit(True)))).alias("_kept")).drop(
        "_kept")
