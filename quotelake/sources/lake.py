"""The five tables of the lake: places, readers, batch writers, registration."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.schema import (
    BRONZE_COLUMNS, BRONZE_PARTITIONS, GOLD_COLUMNS, GOLD_PARTITIONS,
    QUARANTINE_COLUMNS, SILVER_COLUMNS, SILVER_PARTITIONS, ddl,
)
from quotelake.sources import files, snapshots


@dataclass(frozen=True)
class TableSpec:
    """Name, columns and partition columns of one table. ``snapshots``: its days are replaced
    as a whole (``sources.snapshots``). ``lookup``: columns that readers ask for by value."""

    schema: str
    name: str
    columns: tuple[str, ...]
    partitions: tuple[str, ...] = ()
    snapshots: bool = False
    lookup: tuple[str, ...] = ()

    @property
    def path(self) -> str:
        return f"{self.schema}/{self.name}"

    @property
    def stored_columns(self) -> tuple[str, ...]:
        return self.columns + tuple(c for c in self.partitions if c not in self.columns)


BRONZE = TableSpec("bronze", "quotes", BRONZE_COLUMNS, BRONZE_PARTITIONS)
SILVER = TableSpec("silver", "quotes", SILVER_COLUMNS, SILVER_PARTITIONS, lookup=("symbol",))
QUARANTINE = TableSpec("silver", "quotes_rejected", QUARANTINE_COLUMNS, BRONZE_PARTITIONS)
GOLD_OPERATIONAL = TableSpec("gold", "prices_by_ingest_5min", GOLD_COLUMNS, GOLD_PARTITIONS, True)
GOLD_FINANCIAL = TableSpec("gold", "prices_by_quote_5min", GOLD_COLUMNS, GOLD_PARTITIONS, True)
# Quotes behind the Silver stream's watermark, found again in batch; not one of the five.
SILVER_LATE = TableSpec("silver", "quotes_late", SILVER_COLUMNS, SILVER_PARTITIONS, lookup=("symbol",))
TABLES = (BRONZE, SILVER, QUARANTINE, GOLD_OPERATIONAL, GOLD_FINANCIAL)
# Partition column -> the time whose day it is.
DAY_OF = {"kafka_date": "kafka_time", "window_date": "window_start"}


def location(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.path}"


def table_exists(spark: SparkSession, root: str, spec: TableSpec) -> bool:
    """Whether the table's folder is there."""
    return files.exists(spark, location(root, spec))


def placed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The stored columns of a table, with its days."""
    for column in spec.partitions:
        if column in DAY_OF:
            df = df.withColumn(column, F.date_format(DAY_OF[column], "yyyy-MM-dd"))
    return df.select(*spec.stored_columns)


def stored_rows(spark: SparkSession, root: str, spec: TableSpec, fmt: str = "parquet") -> DataFrame:
    """All columns of a stored table."""
    place = location(root, spec)
    if fmt == "parquet" and spec.snapshots:
        return snapshots.read(spark, place, spec.stored_columns)
    reader = spark.read.format(fmt)
    if fmt == "parquet":
        # Declared, so that partition values such as 2024-01-05 stay text.
        reader = reader.schema(ddl(spec.stored_columns))
    return reader.load(place).select(*spec.stored_columns)


def read_table(spark: SparkSession, root: str, spec: TableSpec, fmt: str = "parquet",
               partitions: bool = False) -> DataFrame:
    """A stored table with its columns in order, followed by its days if asked for."""
    return stored_rows(spark, root, spec, fmt).select(*spec.columns, *[
        c for c in spec.partitions if partitions and c not in spec.columns])


def footer_counts(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """Rows per day of a Parquet table, from the footers of its files, or from the manifest of
    a table of snapshots: no column is read."""
    place = location(root, spec)
    if spec.snapshots:
        held = (snapshots.latest(spark, place) or snapshots.Manifest()).days
        return spark.createDataFrame([(spec.path, day, found.rows) for day, found in sorted(held.items())],
                                     "table_path string, day string, rows bigint")
    day = spec.partitions[0]
    listed = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(listed)
    # Only the newer interface of the Parquet source pushes aggregates down.
    spark.conf.set(listed, ",".join(name for name in before.split(",") if name != "parquet"))
    try:
        rows = spark.read.schema(ddl(spec.stored_columns)).parquet(place)
    finally:
        spark.conf.set(listed, before)
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(spec.path).alias("table_path"), F.col(day).alias("day"), "rows")


def all_silver(spark: SparkSession, root: str, fmt: str = "parquet", partitions: bool = False) -> DataFrame:
    """Silver with the quotes that came too late for its stream, each quote once."""
    silver = read_table(spark, root, SILVER, fmt, partitions)
    if not table_exists(spark, root, SILVER_LATE):
        return silver
    return silver.unionByName(read_table(spark, root, SILVER_LATE, fmt, partitions))


def stream_table(spark: SparkSession, root: str, spec: TableSpec, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None,
                 days: Sequence[str] | None = None) -> DataFrame:
    """A stored table as a stream of appended rows, of some ``days`` only if they are given.

    ``max_files_per_trigger`` bounds a micro-batch of a job without a watermark. In front
    of one it would lose rows: files are not in the order of their quotes, so the
    watermark of an early file passes the quotes of later ones.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "parquet":
        reader = reader.schema(ddl(spec.stored_columns))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    place = location(root, spec)
    if days:
        place += f"/{spec.partitions[0]}={{{','.join(days)}}}"
    return reader.load(place).select(*spec.columns)


def write_table(df: DataFrame, root: str, spec: TableSpec, fmt: str = "parquet",
                mode: str = "append") -> None:
    """Batch write in the table's layout; ``overwrite`` replaces the whole table.

    Tables are rebalanced on their partition columns: few files per partition, and
    adaptive execution splits a partition that is too large for a task, so the files of a
    day follow its bytes. Inside each file rows are ordered by the hour of their time, by
    the columns that are looked up, then by time: pages and row groups have narrow bounds
    both of times and of symbols, and a Bloom filter tells what a row group lacks. A parquet
    table a stream appends to is not written in batch as well: its readers follow the
    stream's own file log. A table of snapshots is always replaced as a whole.
    """
    order = next(DAY_OF[c] for c in spec.partitions if c in DAY_OF)
    rows, place = placed(df, spec), location(root, spec)
    if spec.snapshots and fmt == "parquet":
        if mode != "overwrite":
            raise ValueError(f"{spec.path} is written by days (sources.snapshots)")
        snapshots.publish(rows, place, snapshots.latest(df.sparkSession, place))
        return
    (rows.hint("rebalance", *spec.partitions)
     .sortWithinPartitions(*spec.partitions, *[F.date_trunc("hour", order)] * bool(spec.lookup), *spec.lookup, order)
     .write.format(fmt).mode(mode).options(partitionOverwriteMode="static", **lookup_options(spec))
     .partitionBy(*spec.partitions).save(place))


def lookup_options(spec: TableSpec) -> dict[str, str]:
    """Writer options: Bloom filters of the columns that are looked up."""
    return {f"parquet.bloom.filter.enabled#{column}": "true" for column in spec.lookup}


@dataclass(frozen=True)
class Lake:
    """The five tables as DataFrames."""

    bronze: DataFrame
    silver: DataFrame
    quarantine: DataFrame
    gold_operational: DataFrame
    gold_financial: DataFrame


def open_lake(spark: SparkSession, root: str, fmt: str = "parquet") -> Lake:
    """The stored tables under ``root``, with their days; late quotes are part of Silver."""
    return Lake(*(_layer(spark, root, spec, fmt) for spec in TABLES))


def _layer(spark: SparkSession, root: str, spec: TableSpec, fmt: str) -> DataFrame:
    return all_silver(spark, root, fmt, True) if spec == SILVER else read_table(spark, root, spec, fmt, True)


def qualified(spec: TableSpec, prefix: str = "") -> str:
    return f"{prefix}{spec.schema}.{spec.name}"


def missing_tables(spark: SparkSession, prefix: str = "") -> list[str]:
    """Names of lake tables the catalog does not know."""
    return [qualified(spec, prefix) for spec in TABLES
            if not spark.catalog.tableExists(qualified(spec, prefix))]


def catalog_lake(spark: SparkSession, prefix: str = "") -> Lake:
    """The registered tables as they are now; names every table that is missing.

    The catalog gives each table's place and format. Rows are read from there, so that
    partitions written after the registration count, and files of an unfinished stream
    batch do not.
    """
    missing = missing_tables(spark, prefix)
    if missing:
        raise LookupError(f"tables not registered: {', '.join(missing)}")
    tables = []
    for spec in TABLES:
        root, fmt = _registered(spark, spec, prefix)
        tables.append(_layer(spark, root, spec, fmt))
    return Lake(*tables)


def _registered(spark: SparkSession, spec: TableSpec, prefix: str) -> tuple[str, str]:
    """Root folder and format of a registered table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(spec, prefix)}").filter(
        F.col("col_name").isin("Location", "Provider")).collect()
    found = {row.col_name: row.data_type for row in rows}
    return found["Location"].rstrip("/").removesuffix(f"/{spec.path}"), found["Provider"].lower()


def register_tables(spark: SparkSession, root: str, fmt: str = "parquet",
                    prefix: str = "") -> list[str]:
    """Create the three schemas and five external tables where absent.

    Runs any number of times.
    """
    for schema in dict.fromkeys(spec.schema for spec in TABLES):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{prefix}{schema}` "
                  f"LOCATION '{root.rstrip('/')}/{schema}'")
    for spec in TABLES:
        layout = f"({ddl(spec.stored_columns)}) USING {fmt}" if fmt == "parquet" else f"USING {fmt}"
        if spec.partitions and fmt == "parquet":
            layout += f" PARTITIONED BY ({', '.join(f'`{p}`' for p in spec.partitions)})"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(spec, prefix)} {layout} "
                  f"LOCATION '{location(root, spec)}'")
        if fmt == "parquet" and spec.snapshots:
            register_days(spark, root, spec, prefix)
        elif fmt == "parquet" and spec.partitions:
            spark.catalog.recoverPartitions(qualified(spec, prefix))
    return [qualified(spec, prefix) for spec in TABLES]


def register_days(spark: SparkSession, root: str, spec: TableSpec, prefix: str = "") -> None:
    """Points the partitions of a registered table to the snapshots of its newest manifest.

    A day changes its folder in one step, so any reader of the catalog sees each window
    once. Gold jobs do this after each batch if they are told the prefix.
    """
    table, place = qualified(spec, prefix), location(root, spec)
    manifest = snapshots.latest(spark, place) or snapshots.Manifest()
    known = {row[0].split("=", 1)[-1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for day, held in sorted(manifest.days.items()):
        folder = f"{place}/{snapshots.GOLD.folder(day, held.snapshot)}"
        day_of = f"PARTITION ({snapshots.GOLD.day}='{day}')"
        spark.sql(f"ALTER TABLE {table} {day_of} SET LOCATION '{folder}'" if day in known
                  else f"ALTER TABLE {table} ADD IF NOT EXISTS {day_of} LOCATION '{folder}'")
    for day in sorted(known - {*manifest.days}):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({snapshots.GOLD.day}='{day}')")
    spark.catalog.refreshTable(table)
