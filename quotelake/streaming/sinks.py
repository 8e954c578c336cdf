"""Streaming writers: appended tables, and Gold kept current by snapshots of its days."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from quotelake.schema import GOLD_KEY, ddl
from quotelake.sources import files, snapshots
from quotelake.sources.lake import (
    TableSpec, location, lookup_options, placed, register_days, table_exists,
)

FIVE_MINUTES = {"processingTime": "5 minutes"}
ALL_AVAILABLE = {"availableNow": True}
GOLD_MODES = ("complete", "update", "append")
PROGRESS = ("query string, batch_id long, input_rows long, dropped_rows long, state_rows long, "
            "watermark string, started string")


def ensure_table(spark: SparkSession, root: str, spec: TableSpec, fmt: str = "parquet") -> None:
    """Create the table if absent, so that a downstream stream can start first. A table that
    is there is left alone."""
    if spec.snapshots and fmt == "parquet":
        snapshots.create(spark, location(root, spec), spec.stored_columns)
        return
    if table_exists(spark, root, spec):
        return
    empty = spark.createDataFrame([], ddl(spec.stored_columns))
    empty.write.format(fmt).mode("append").partitionBy(*spec.partitions).save(location(root, spec))


def _triggered(writer: DataStreamWriter, name: str, checkpoint: str,
               trigger: dict | None) -> DataStreamWriter:
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger) if trigger else writer


def gathered(df: DataFrame, spec: TableSpec, writers: int | None) -> DataFrame:
    """Rows of one day brought together, so that a trigger does not leave tasks x days files.

    Without state in the stream, adaptive execution does it by size: small days share a task,
    a day that holds most rows is split. A stream with state has no adaptive execution; there
    ``writers`` tasks share the rows of a day, a number that is to follow what the largest day
    gets in a trigger.
    """
    if writers is None:
        return df.hint("rebalance", *spec.partitions)
    lane = F.pmod(F.xxhash64(*[c for c in df.columns if c not in spec.partitions]), F.lit(writers))
    return df.repartition(*spec.partitions, lane)


def append_stream(df: DataFrame, root: str, spec: TableSpec, name: str, checkpoint: str,
                  trigger: dict | None = None, fmt: str = "parquet",
                  writers: int | None = None) -> StreamingQuery:
    """Append new rows; without a trigger, batches follow each other at once. ``writers`` as in
    ``gathered``."""
    writer = gathered(placed(df, spec), spec, writers).writeStream.format(fmt).outputMode("append")
    return _triggered(writer.options(**lookup_options(spec)).partitionBy(*spec.partitions), name,
                      checkpoint, trigger).start(location(root, spec))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the query that a checkpoint belongs to; a new checkpoint has a new one."""
    return json.loads(files.read_text(spark, f"{checkpoint}/metadata"))["id"]


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for a while."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def adaptive(spark: SparkSession) -> AbstractContextManager[None]:
    """Adaptive execution for the jobs inside a batch; the session of a stream with state has
    it turned off, which the stream itself needs."""
    return _setting(spark, "spark.sql.adaptive.enabled", "true")


def without_empty_batches(spark: SparkSession) -> AbstractContextManager[None]:
    """For the start of a stream that another run follows on the same checkpoint: by default a
    batch without rows comes after each one that moved the watermark, and opens and stores the
    state of every task again. The next run lets the same state go. What is late is judged by
    the watermark a batch before, so rows of the next run are dropped later, if at all.
    A stream takes the setting when it starts and keeps it."""
    return _setting(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false")


def gold_days(rows: DataFrame, base: snapshots.Manifest, place: str,
              mode: str) -> tuple[DataFrame | None, list[str]]:
    """The rows of days that a batch changes, None if there are none, and the days that stay.

    A complete result is compared with the manifest by the digests of its days, so that no
    stored window is read; a result of changed windows takes the others of its days from
    their snapshots.
    """
    digests = snapshots.day_digests(rows)
    if mode == "complete":
        changed = snapshots.changed_days(digests, base)
        stay = [day for day in digests if day not in changed]
        if not changed and {*digests} == {*base.days}:
            return None, stay
        return snapshots.of_days(rows, changed), stay
    touched = sorted(digests)
    if not touched:
        return None, [*base.days]
    stored = snapshots.read(rows.sparkSession, place, rows.columns, base, touched)
    others = stored.join(rows.select(*GOLD_KEY), list(GOLD_KEY), "left_anti").select(*rows.columns)
    return rows.unionByName(others), [day for day in base.days if day not in digests]


def write_gold(batch: DataFrame, batch_id: int, root: str, spec: TableSpec, mode: str, writer: str,
               registered: str | None = None) -> None:
    """Brings a Gold table to the state after a batch, in one step; a batch that is in the table
    already changes nothing. With ``registered``, the prefix of its catalog table, that table
    follows."""
    spark, place = batch.sparkSession, location(root, spec)
    base = snapshots.latest(spark, place) or snapshots.Manifest()
    if not base.holds(writer, batch_id):
        rows = placed(batch, spec).persist()
        try:
            with adaptive(spark):
                found, stay = gold_days(rows, base, place, mode)
                if found is not None:
                    snapshots.publish(found, place, base, stay, writer, batch_id)
        finally:
            rows.unpersist()
    if registered is not None:
        register_days(spark, root, spec, registered)


def _replaced(batch: DataFrame, root: str, spec: TableSpec, mode: str, writer: str, batch_id: int) -> None:
    """The same for a Delta table, whose own log replaces days in one step."""
    rows = placed(batch, spec).persist()
    try:
        days = sorted(snapshots.day_digests(rows))
        if mode != "complete":
            stored = snapshots.of_days(batch.sparkSession.read.format("delta").load(location(root, spec)), days)
            rows = rows.unionByName(stored.join(rows.select(*GOLD_KEY), list(GOLD_KEY), "left_anti").select(*rows.columns))
        if days:
            (rows.write.format("delta").mode("overwrite").partitionBy(*spec.partitions)
             .options(txnAppId=writer, txnVersion=batch_id,
                      replaceWhere=f"{snapshots.GOLD.day} IN ({', '.join(repr(day) for day in days)})")
             .save(location(root, spec)))
    finally:
        rows.unpersist()


def gold_stream(gold: DataFrame, root: str, spec: TableSpec, name: str, checkpoint: str,
                mode: str = "complete", trigger: dict | None = None,
                fmt: str = "parquet", registered: str | None = None) -> StreamingQuery:
    """Keep a Gold table current.

    ``complete`` looks at every window per trigger and replaces the days that changed: late
    rows always count, state never expires. ``update`` gets the changed windows only and
    lets state expire. ``append`` writes a window once, after the watermark has passed it.
    A repeated batch leaves the same windows in each mode, and each window is there once.
    """
    if mode not in GOLD_MODES:
        raise ValueError(f"mode must be one of {GOLD_MODES}, got {mode!r}")
    ensure_table(gold.sparkSession, root, spec, fmt)

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = stream_id(batch.sparkSession, checkpoint)
        if fmt == "parquet":
            write_gold(batch, batch_id, root, spec, mode, writer, registered)
        else:
            _replaced(batch, root, spec, mode, writer, batch_id)
    return _triggered(gold.writeStream.outputMode(mode).foreachBatch(write), name, checkpoint, trigger).start()


def _progress_row(progress: dict) -> dict:
    states = progress["stateOperators"]
    return {
        "batch_id": progress["batchId"],
        "input_rows": progress["numInputRows"],
        "dropped_rows": sum(s["numRowsDroppedByWatermark"] for s in states),
        "state_rows": sum(s["numRowsTotal"] for s in states),
        "watermark": (progress.get("eventTime") or {}).get("watermark"),
    }


def batch_progress(query: StreamingQuery) -> list[dict]:
    """Rows read, dropped behind the watermark and in state, of the batches that the query
    still remembers (the newest 100 by default); ``ProgressLog`` keeps all."""
    return [_progress_row(progress) for progress in query.recentProgress]


class ProgressLog(StreamingQueryListener):
    """A row for every batch of every query, in a table of JSON lines.

    Each run of a query has one file an hour, written again with each batch: no Spark job
    runs for it, and files do not grow in number with the batches. Dropped rows reach neither Silver nor quarantine; this is where they show, and
    ``operators.late.lost_quotes`` finds them. Add it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.place, self.lines = {}, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        row = {"query": progress.get("name"), "started": progress.get("timestamp"), **_progress_row(progress)}
        run, hour = progress["runId"], progress["timestamp"][:13].replace(":", "")
        if self.place.get(run) != hour:
            self.place[run], self.lines[run] = hour, []
        self.lines[run].append(json.dumps(row))
        files.put_text(self.spark, f"{self.path}/{row['query'] or 'query'}-{run}-{hour}.json",
                       "\n".join(self.lines[run]) + "\n")

    def onQueryTerminated(self, event) -> None:
        self.place.pop(str(event.runId), None)
        self.lines.pop(str(event.runId), None)
