"""Batch build of the five tables, for backfills and recomputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from quotelake.operators.bronze import to_bronze
from quotelake.operators.gold import to_gold_financial, to_gold_operational
from quotelake.operators.quarantine import to_quarantine
from quotelake.operators.silver import to_silver
from quotelake.sources import lake


def build_lake(spark: SparkSession, messages: DataFrame, root: str, *,
               bronze_clock: Column | None = None, silver_clock: Column | None = None,
               gold_clock: Column | None = None, fmt: str = "parquet") -> lake.Lake:
    """Refine all messages into the five tables under ``root``, replacing what is there.

    Every layer reads the stored one before it, so messages are parsed once and a lost
    executor costs its own tasks only; a build that broke off is simply run again.
    """
    def store(df: DataFrame, spec: lake.TableSpec) -> None:
        lake.write_table(df, root, spec, fmt, "overwrite")

    store(to_bronze(messages, bronze_clock), lake.BRONZE)
    bronze = lake.read_table(spark, root, lake.BRONZE, fmt)
    store(to_quarantine(bronze), lake.QUARANTINE)
    store(to_silver(bronze, clock=silver_clock), lake.SILVER)
    if lake.table_exists(spark, root, lake.SILVER_LATE):
        store(lake.read_table(spark, root, lake.SILVER, fmt).limit(0), lake.SILVER_LATE)
    silver = lake.read_table(spark, root, lake.SILVER, fmt)
    for spec, refine in ((lake.GOLD_OPERATIONAL, to_gold_operational),
                         (lake.GOLD_FINANCIAL, to_gold_financial)):
        store(refine(silver, clock=gold_clock), spec)
    return lake.open_lake(spark, root, fmt)
