"""Partial aggregates kept by a stream over Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quotelake.operators.partials import COUNTS, DAY, MINUTES, PARTIALS, SECONDS, Kept, Partial
from quotelake.sources import snapshots
from quotelake.streaming.sinks import adaptive, stream_id


def _place(root: str, partial: Partial) -> str:
    return f"{root.rstrip('/')}/metrics/{partial.name}"


def add_batch(batch: DataFrame, batch_id: int, root: str, writer: str) -> None:
    """Merges the partials of a batch into those of its days; a batch that comes again adds
    nothing, table by table. Days without rows in the batch are not opened."""
    spark = batch.sparkSession
    rows = batch.persist()
    try:
        with adaptive(spark):
            for partial, make in PARTIALS.items():
                place = _place(root, partial)
                base = snapshots.latest(spark, place) or snapshots.Manifest()
                if base.holds(writer, batch_id):
                    continue
                new = make(rows)
                days = [row[0] for row in new.select(DAY).distinct().collect()]
                stored = snapshots.read(spark, place, partial.columns, base, days, partial.shape)
                merged = partial.merged(stored.unionByName(new)).select(*partial.columns)
                if days:
                    snapshots.publish(merged, place, base, [d for d in base.days if d not in days], writer,
                                      batch_id, partial.shape)
    finally:
        rows.unpersist()


def keep_partials(silver: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keeps the partials under ``root`` current with a stream of Silver rows. There is no state
    in the stream, so its batches may be bounded in any order of files."""
    for partial in PARTIALS:
        snapshots.create(silver.sparkSession, _place(root, partial), partial.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        add_batch(batch, batch_id, root, stream_id(batch.sparkSession, checkpoint))
    writer = silver.writeStream.foreachBatch(write).queryName("partials").option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def open_partials(spark: SparkSession, root: str) -> Kept:
    """The partials as they are now."""
    return Kept(*(snapshots.read(spark, _place(root, partial), partial.columns, shape=partial.shape)
                  for partial in (COUNTS, SECONDS, MINUTES)))


def vacuum_partials(spark: SparkSession, root: str, keep: int = 2) -> int:
    return sum(len(snapshots.vacuum(spark, _place(root, partial), keep, partial.shape)) for partial in PARTIALS)
