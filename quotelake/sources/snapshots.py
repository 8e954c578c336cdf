"""Tables that are replaced day by day: immutable snapshots, and a manifest that names them.

A day of the table is one folder ``<day column>=D/v=<version>-<attempt>`` that holds each row of
its key once. Manifest ``n`` lists the folder, row count and digest of every day; putting it in its
place is the commit. A reader takes the newest manifest and opens its folders, so it sees
one state of the table, and what a broken write left behind is never read.

Versions count up from the manifest before, and a manifest names the writer and the batch it
was made from: a batch that comes again changes nothing, and no clock is asked.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.schema import GOLD_KEY, GOLD_VALUES, ddl
from quotelake.sources import files

SNAPSHOT, MANIFESTS = "v", "_manifest"


@dataclass(frozen=True)
class Shape:
    """The column of a table's days, the columns that tell whether a row has changed, and the
    order of rows in a file."""

    day: str
    hashed: tuple[str, ...]
    order: str

    def folder(self, day: str, snapshot: str) -> str:
        return f"{self.day}={day}/{SNAPSHOT}={snapshot}"


GOLD = Shape("window_date", (*GOLD_KEY, *GOLD_VALUES), "window_start")


@dataclass(frozen=True)
class Day:
    """Snapshot of a day: its folder's version, rows, and the sum of its rows' hashes."""

    snapshot: str
    rows: int
    digest: str


@dataclass(frozen=True)
class Manifest:
    """State of a table. ``layout`` is the schema its files were written with."""

    version: int = 0
    writer: str = ""
    batch: int = -1
    layout: str = ""
    days: dict[str, Day] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def parse(cls, text: str) -> Manifest:
        read = json.loads(text)
        return cls(**{**read, "days": {day: Day(**held) for day, held in read["days"].items()}})

    def holds(self, writer: str, batch: int) -> bool:
        """Whether this batch is in the table already."""
        return self.writer == writer and self.batch >= batch


def _numbers(spark: SparkSession, place: str) -> list[int]:
    found = files.names(spark, f"{place}/{MANIFESTS}/*.json")
    return sorted(int(name.rsplit("/", 1)[-1].removesuffix(".json")) for name in found)


def _manifest_place(place: str, number: int) -> str:
    return f"{place}/{MANIFESTS}/{number:012d}.json"


def latest(spark: SparkSession, place: str) -> Manifest | None:
    """The newest manifest of the table at ``place``; None where there is no such table."""
    numbers = _numbers(spark, place)
    return Manifest.parse(files.read_text(spark, _manifest_place(place, numbers[-1]))) if numbers else None


def create(spark: SparkSession, place: str, columns: Iterable[str]) -> None:
    """An empty table, where there is none."""
    if latest(spark, place) is None:
        files.create_text(spark, _manifest_place(place, 0), Manifest(layout=ddl(columns)).text())


def _folders(place: str, days: dict[str, Day], shape: Shape) -> list[str]:
    return [f"{place}/{shape.folder(day, held.snapshot)}" for day, held in sorted(days.items())]


def read(spark: SparkSession, place: str, columns: Iterable[str], manifest: Manifest | None = None,
         only: Iterable[str] | None = None, shape: Shape = GOLD) -> DataFrame:
    """The rows of a manifest (the newest unless given), of the days ``only`` if given."""
    manifest = manifest or latest(spark, place) or Manifest()
    wanted = manifest.days if only is None else {d: manifest.days[d] for d in only if d in manifest.days}
    columns = list(columns)
    if not wanted:
        return spark.createDataFrame([], ddl(columns))
    return (spark.read.schema(ddl(columns)).option("basePath", place)
            .parquet(*_folders(place, wanted, shape)).select(*columns))


def day_digests(rows: DataFrame, shape: Shape = GOLD) -> dict[str, tuple[int, str]]:
    """Rows of each day, and the sum of the hashes of their windows and values; the order of
    rows and the time of writing do not count. One row per day reaches the driver."""
    digest = F.sum(F.xxhash64(*shape.hashed).cast("decimal(20,0)")).cast("string")
    found = rows.groupBy(shape.day).agg(F.count(F.lit(1)).alias("rows"), digest.alias("digest")).collect()
    return {row[shape.day]: (row["rows"], row["digest"]) for row in found}


def changed_days(digests: dict[str, tuple[int, str]], manifest: Manifest) -> list[str]:
    """Days whose windows are not those of the manifest."""
    return sorted(day for day, held in digests.items()
                  if day not in manifest.days
                  or (manifest.days[day].rows, manifest.days[day].digest) != held)


def of_days(rows: DataFrame, days: Iterable[str], shape: Shape = GOLD) -> DataFrame:
    """Rows of some days, by a filter of literals."""
    return rows.filter(F.col(shape.day).isin(*days))


def publish(rows: DataFrame, place: str, base: Manifest | None, keep: Iterable[str] = (),
            writer: str = "", batch: int = -1, shape: Shape = GOLD) -> Manifest:
    """Writes whole days and puts the next manifest in its place: the written days, and the
    days ``keep`` of ``base`` as they are. Fails if another writer was faster."""
    spark, base = rows.sparkSession, base or Manifest()
    version = base.version + 1
    tag = f"{version:012d}-{uuid.uuid4().hex[:12]}"
    (rows.hint("rebalance", shape.day).sortWithinPartitions(shape.day, shape.order).withColumn(SNAPSHOT, F.lit(tag))
     .write.mode("append").partitionBy(shape.day, SNAPSHOT).parquet(place))
    written = [name.rsplit(f"{shape.day}=", 1)[-1].split("/")[0]
               for name in files.names(spark, f"{place}/{shape.folder('*', tag)}")]
    columns = rows.columns
    made = read(spark, place, columns, Manifest(days={day: Day(tag, 0, "") for day in written}), shape=shape)
    days = {day: Day(tag, *held) for day, held in day_digests(made, shape).items()}
    manifest = Manifest(version, writer, batch, ddl(columns), {**{d: base.days[d] for d in keep if d in base.days}, **days})
    if not files.create_text(spark, _manifest_place(place, version), manifest.text()):
        raise RuntimeError(f"{place}: version {version} was written by another job")
    return manifest


def vacuum(spark: SparkSession, place: str, keep: int = 2, shape: Shape = GOLD) -> list[str]:
    """Removes manifests before the last ``keep`` and the snapshots that none of those names;
    returns the folders removed. A write that is under way has a version of its own and stays,
    readers that opened an older manifest do not."""
    numbers = _numbers(spark, place)
    kept = [Manifest.parse(files.read_text(spark, _manifest_place(place, n))) for n in numbers[-keep:]]
    live = {folder for manifest in kept for folder in _folders("", manifest.days, shape)}
    newest = numbers[-1] if numbers else 0
    gone = []
    for folder in files.names(spark, f"{place}/{shape.folder('*', '*')}"):
        own = f"/{shape.day}=" + folder.rsplit(f"/{shape.day}=", 1)[-1]
        if own not in live and int(own.rsplit("=", 1)[-1].split("-")[0]) <= newest:
            files.remove(spark, folder)
            gone.append(folder)
    for number in numbers[:-keep]:
        files.remove(spark, _manifest_place(place, number))
    return gone
