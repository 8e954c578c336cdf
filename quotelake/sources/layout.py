"""Layout guard: does a stored table still have the layout a job will write?

A layout maps each column to its type and its place among the partition columns (from 1;
0 for a column inside the files). Two layouts are compared column by column, and every
column in which they differ makes one row.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.operators.logs import LAYOUT_DIFFERS, LAYOUT_FITS
from quotelake.schema import ddl
from quotelake.sources import files, snapshots
from quotelake.sources.lake import TableSpec, location

# How a missing table shows when it is read.
_ABSENT = ("PATH_NOT_FOUND", "DELTA_TABLE_NOT_FOUND", "DELTA_MISSING_DELTA_TABLE")
FINGERPRINTS = "_layout"
OVERLAP = 3_600_000
CHECK_SCHEMA = ("timestamp string, level string, service string, event string, message string, "
                "erro string")


class Place(NamedTuple):
    """Type of a column, and its place in the partitioning."""

    type: str
    partition: int = 0

    def __str__(self) -> str:
        return f"partition {self.partition}" if self.partition else self.type


Layout = dict[str, Place]


class LayoutMismatch(RuntimeError):
    """The stored table and the planned output differ."""


def layout_of(schema: T.StructType, partitions: Sequence[str] = ()) -> Layout:
    return {f.name: Place(f.dataType.simpleString(), list(partitions).index(f.name) + 1
                          if f.name in partitions else 0) for f in schema}


def planned_layout(spec: TableSpec) -> Layout:
    """What the writers of a table produce."""
    return layout_of(T.StructType.fromDDL(ddl(spec.stored_columns)), spec.partitions)


def layout_differences(stored: Layout, planned: Layout) -> list[tuple[str, str | None, str | None]]:
    """(column, stored, planned) for each column that differs; None where it is absent.

    Partition values have no type of their own in a path, so partition columns are compared
    by their place alone.
    """
    found = []
    for column in sorted({*stored, *planned}):
        have, want = stored.get(column), planned.get(column)
        if have is None or want is None or str(have) != str(want):
            found.append((column, have and str(have), want and str(want)))
    return found


def stored_layout(spark: SparkSession, table: str) -> Layout | None:
    """Layout of a catalog table; None if it does not exist."""
    if not spark.catalog.tableExists(table):
        return None
    columns = spark.catalog.listColumns(table)
    order = [c.name for c in columns if c.isPartition]
    return {c.name: Place(c.dataType, order.index(c.name) + 1 if c.isPartition else 0)
            for c in columns}


def stored_file_layout(spark: SparkSession, root: str, spec: TableSpec, fmt: str = "parquet",
                       since: int = 0) -> Layout | None:
    """Layout of the files of a table that were modified from ``since`` on (milliseconds); None
    where there are none.

    Directory levels ``name=value`` between the table folder and a file are its partition
    columns, in order. Files of several partitionings are a mismatch of their own.
    """
    return _files_layout(spark, root, spec, fmt, since)[0]


def _files_layout(spark: SparkSession, root: str, spec: TableSpec, fmt: str,
                  since: int) -> tuple[Layout | None, int]:
    """The layout, and when the newest of these files was modified."""
    place = location(root, spec)
    if fmt == "delta":
        return _delta_layout(spark, place), 0
    if spec.snapshots:
        # Its readers open no file but those that the manifest names.
        manifest = snapshots.latest(spark, place)
        return manifest and layout_of(T.StructType.fromDDL(manifest.layout), spec.partitions), 0
    if not files.exists(spark, place):
        return None, 0
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option(
        "modifiedAfter", f"{datetime.fromtimestamp(since / 1000, timezone.utc):%Y-%m-%dT%H:%M:%S}").option("timeZone", "UTC")
    # Paths are listed, contents are not read; one row per partitioning comes back.
    below = F.regexp_replace(F.regexp_extract("path", f"/{spec.path}/(.*)$", 1), "[^/]*$", "")
    levels = F.transform(F.filter(F.split(below, "/"), lambda part: part.contains("=")),
                         lambda part: F.substring_index(part, "=", 1))
    found = (reader.format("binaryFile").load(place).groupBy(levels.alias("levels"))
             .agg(F.unix_millis(F.max("modificationTime")).alias("newest")).collect())
    if not found:
        return None, 0
    if len(found) > 1:
        raise LayoutMismatch(
            f"{spec.path} holds files of several partitionings: {sorted(tuple(row.levels) for row in found)}")
    try:
        frame = reader.format("parquet").option("mergeSchema", "true").load(place)
    except (PySparkException, Py4JJavaError) as problem:
        raise LayoutMismatch(f"{spec.path} can not be read as one table: {str(problem)[:1000]}") from problem
    order = list(found[0].levels)
    inside = {c: p for c, p in layout_of(frame.schema).items() if c not in order}
    return {**inside, **{c: Place("string", order.index(c) + 1) for c in order}}, found[0].newest


def _delta_layout(spark: SparkSession, place: str) -> Layout | None:
    try:
        schema = spark.read.format("delta").load(place).schema
    except PySparkException as problem:
        if any(mark in str(problem) for mark in _ABSENT):
            return None
        raise
    detail = spark.sql(f"DESCRIBE DETAIL delta.`{place}`").select("partitionColumns").first()
    return layout_of(schema, list(detail[0]))


def known_layout(spark: SparkSession, root: str, spec: TableSpec) -> tuple[Layout | None, int]:
    """The newest fingerprint of a table: its layout, and up to when its files were looked at."""
    found = files.names(spark, f"{location(root, spec)}/{FINGERPRINTS}/*.json")
    if not found:
        return None, 0
    read = json.loads(files.read_text(spark, found[-1]))
    return {c: Place(*place) for c, place in read.items()}, int(found[-1].rsplit("/", 1)[-1].removesuffix(".json"))


def checked_layout(spark: SparkSession, root: str, spec: TableSpec, fmt: str = "parquet") -> Layout | None:
    """Layout of a table, with the footers of the files since its last fingerprint only.

    Files are looked at again for ``OVERLAP`` before that, as a file can be put in its place
    a while after it was written. A file that differs from the fingerprint is a mismatch.
    """
    known, upto = known_layout(spark, root, spec)
    new, newest = _files_layout(spark, root, spec, fmt, max(0, upto - OVERLAP))
    if known and new and layout_differences(known, new):
        raise LayoutMismatch(f"{spec.path} holds files of several layouts: {layout_differences(known, new)}")
    if new and newest > upto:
        files.create_text(spark, f"{location(root, spec)}/{FINGERPRINTS}/{newest:015d}.json", json.dumps(new))
    return known or new


def record_check(spark: SparkSession, place: str, spec: TableSpec, differences: list[tuple]) -> None:
    """Appends the outcome of a check as a log line: one event, its table and differences."""
    line = {
        "timestamp": datetime.now(timezone.utc).isoformat(), "service": "layout", "message": spec.path,
        "level": "ERROR" if differences else "INFO",
        "event": LAYOUT_DIFFERS if differences else LAYOUT_FITS, "erro": str(differences) if differences else None,
    }
    spark.createDataFrame([line], CHECK_SCHEMA).coalesce(1).write.mode("append").json(place)


def require_layout(spark: SparkSession, root: str, spec: TableSpec, planned: DataFrame,
                   fmt: str = "parquet", checks: str | None = None) -> None:
    """Stop before a stream starts on a table of another layout; no table passes. With
    ``checks`` every outcome is appended to the log lines in that folder."""
    stored = checked_layout(spark, root, spec, fmt)
    if stored is None:
        return
    made = layout_of(planned.schema)
    added = {c: p for c, p in planned_layout(spec).items() if p.partition}
    found = layout_differences(stored, {**made, **added})
    if checks:
        record_check(spark, checks, spec, found)
    if found:
        raise LayoutMismatch(f"{spec.path} has another layout: {found}")
