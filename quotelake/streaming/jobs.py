"""Bronze, Silver, quarantine and the two Gold jobs, wired from source to sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from quotelake.functions.times import event_time
from quotelake.operators import edge
from quotelake.operators.bronze import to_bronze
from quotelake.operators.gold import to_gold_financial, to_gold_operational
from quotelake.operators.late import lost_quotes
from quotelake.operators.quarantine import to_quarantine
from quotelake.operators.silver import to_silver
from quotelake.sources import files, lake, snapshots
from quotelake.sources.layout import require_layout
from quotelake.streaming.committed import NOTHING, finished_entry, plain_path, read_files
from quotelake.streaming.partials import keep_partials, vacuum_partials
from quotelake.streaming.sinks import (
    ALL_AVAILABLE, FIVE_MINUTES, append_stream, ensure_table, gold_stream, stream_id, without_empty_batches,
)

# Days named one by one in a filter; beyond that it names their bounds.
NAMED_DAYS = 400


@dataclass(frozen=True)
class Clocks:
    """Stamps of the three processing steps; None is the wall clock."""

    bronze: Column | None = None
    silver: Column | None = None
    gold: Column | None = None


@dataclass(frozen=True)
class Flow:
    """Places and options shared by the five jobs.

    ``checkpoints`` holds offsets and state and has to outlive the machines, like
    ``root``. The number of shuffle partitions of the session is fixed in a stateful
    checkpoint by its first batch; size it for the full load beforehand. ``writers`` is the
    number of tasks that write a day's rows of one Silver trigger (``sinks.gathered``).
    ``survivor`` says which copy of a quote Silver keeps (``operators.silver``). With
    ``registered``, a prefix of the catalog's schemas, registered Gold tables follow each batch.
    """

    spark: SparkSession
    root: str
    checkpoints: str
    fmt: str = "parquet"
    clocks: Clocks = Clocks()
    max_files_per_trigger: int | None = None
    lanes: int | None = 8
    writers: int = 8
    gold_mode: str = "complete"
    checks: str | None = None
    survivor: str = "seen"
    registered: str | None = None

    def checkpoint(self, job: str) -> str:
        return f"{self.checkpoints.rstrip('/')}/{job}"

    def upstream(self, spec: lake.TableSpec, watermark: bool = True,
                 days: Sequence[str] | None = None) -> DataFrame:
        """A layer as a stream. Jobs with a watermark read all that is there: a bound on
        files would let an early file's watermark drop the rows of later ones. ``days`` of
        the Kafka time are a bound that keeps the order (``backfill_silver``)."""
        if watermark and self.max_files_per_trigger:
            raise ValueError("max_files_per_trigger loses rows in front of a watermark")
        ensure_table(self.spark, self.root, spec, self.fmt)
        return lake.stream_table(self.spark, self.root, spec, self.fmt,
                                 None if watermark else self.max_files_per_trigger, days)

    def all_silver(self) -> DataFrame:
        """Silver as a stream for Gold. A complete result counts late quotes too, whenever the
        late job finds them; the other modes have let their windows go by then."""
        silver = self.upstream(lake.SILVER)
        return silver.unionByName(self.upstream(lake.SILVER_LATE)) if self.gold_mode == "complete" else silver


def start_bronze(flow: Flow, messages: DataFrame,
                 trigger: dict | None = FIVE_MINUTES) -> StreamingQuery:
    """Messages to Bronze, every five minutes."""
    bronze = to_bronze(messages, flow.clocks.bronze)
    require_layout(flow.spark, flow.root, lake.BRONZE, bronze, flow.fmt, flow.checks)
    return append_stream(bronze, flow.root, lake.BRONZE, "bronze", flow.checkpoint("bronze"),
                         trigger, flow.fmt)


def start_silver(flow: Flow, trigger: dict | None = FIVE_MINUTES,
                 days: Sequence[str] | None = None) -> StreamingQuery:
    """Bronze to Silver, every five minutes; refuses a table of another layout."""
    silver = to_silver(flow.upstream(lake.BRONZE, days=days), clock=flow.clocks.silver, lanes=flow.lanes,
                       survivor=flow.survivor)
    require_layout(flow.spark, flow.root, lake.SILVER, silver, flow.fmt, flow.checks)
    return append_stream(silver, flow.root, lake.SILVER, "silver",
                         flow.checkpoint("silver"), trigger, flow.fmt, flow.writers)


def start_quarantine(flow: Flow, trigger: dict | None = None) -> StreamingQuery:
    """Bronze to quarantine, as fast as batches finish; same layout check."""
    quarantine = to_quarantine(flow.upstream(lake.BRONZE, watermark=False))
    require_layout(flow.spark, flow.root, lake.QUARANTINE, quarantine, flow.fmt, flow.checks)
    return append_stream(quarantine, flow.root, lake.QUARANTINE, "quarantine",
                         flow.checkpoint("quarantine"), trigger, flow.fmt)


def start_gold_operational(flow: Flow, trigger: dict | None = FIVE_MINUTES) -> StreamingQuery:
    """Silver to windows by ingestion time, every five minutes."""
    gold = to_gold_operational(flow.all_silver(), clock=flow.clocks.gold)
    require_layout(flow.spark, flow.root, lake.GOLD_OPERATIONAL, gold, flow.fmt, flow.checks)
    return gold_stream(gold, flow.root, lake.GOLD_OPERATIONAL, "gold_operational",
                       flow.checkpoint("gold_operational"), flow.gold_mode, trigger, flow.fmt, flow.registered)


def start_gold_financial(flow: Flow, trigger: dict | None = None) -> StreamingQuery:
    """Silver to windows by quote time, as fast as batches finish."""
    gold = to_gold_financial(flow.all_silver(), clock=flow.clocks.gold)
    require_layout(flow.spark, flow.root, lake.GOLD_FINANCIAL, gold, flow.fmt, flow.checks)
    return gold_stream(gold, flow.root, lake.GOLD_FINANCIAL, "gold_financial",
                       flow.checkpoint("gold_financial"), flow.gold_mode, trigger, flow.fmt, flow.registered)


def backfill_silver(flow: Flow, days_per_batch: int = 1) -> int:
    """Carries a stored Bronze backlog to Silver in the order of its days, ``days_per_batch`` at a
    time; returns the number of runs. A batch then holds a bounded share of the backlog, and
    no day's watermark drops rows of another. Afterwards ``start_silver`` goes on from the
    same checkpoint. Days that are finished are not opened again. Only the last run ends with
    a batch without rows, which brings the state up to the watermark.
    """
    place = lake.location(flow.root, lake.BRONZE)
    days = [name.rsplit("=", 1)[-1] for name in files.names(flow.spark, f"{place}/kafka_date=*")]
    checkpoint = flow.checkpoint("silver")
    read = read_files(flow.spark, checkpoint, NOTHING, finished_entry(flow.spark, checkpoint))
    last = read.agg(F.max(_day_of(F.col("path")))).first()[0] or ""
    days = [day for day in days if day >= last]
    for at in range(0, len(days), days_per_batch):
        last_run = at + days_per_batch >= len(days)
        with nullcontext() if last_run else without_empty_batches(flow.spark):
            drain(lambda: start_silver(flow, ALL_AVAILABLE, days[at:at + days_per_batch]))
    return -(-len(days) // days_per_batch)


def _day_of(path: Column) -> Column:
    return F.regexp_extract(path, "/kafka_date=([^/]+)/", 1)


def on_days(df: DataFrame, column: str, days: Iterable[str]) -> DataFrame:
    """Rows of some days, by a filter of literals: the days, or their bounds if they are many."""
    days = sorted(days)
    return df.filter(F.col(column).isin(*days) if len(days) <= NAMED_DAYS
                     else F.col(column).between(days[0], days[-1]))


def _distinct_days(df: DataFrame, column: Column) -> list[str]:
    """Different days; when there are more than are named anyway, their bounds."""
    days = df.select(column.alias("day")).where("day is not null").distinct()
    found = [row.day for row in days.limit(NAMED_DAYS + 1).collect()]
    if len(found) <= NAMED_DAYS:
        return found
    bounds = days.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    return [bounds.low, *found, bounds.high]


def unjudged_bronze(flow: Flow, after: int, upto: int) -> DataFrame:
    """Bronze rows of the files that Silver has read in the entries after one and up to another.
    Only the days of these files are opened."""
    listed = read_files(flow.spark, flow.checkpoint("silver"), after, upto)
    rows = lake.stored_rows(flow.spark, flow.root, lake.BRONZE, flow.fmt).select(
        "*", plain_path("_metadata.file_path").alias("file_path"))
    rows = on_days(rows, "kafka_date", _distinct_days(listed, _day_of(F.col("path"))))
    return rows.join(listed.select(F.col("path").alias("file_path")), "file_path", "left_semi").select(*lake.BRONZE.columns)


def start_partials(flow: Flow, trigger: dict | None = FIVE_MINUTES) -> StreamingQuery:
    """Silver and its late quotes to the partial aggregates that panels are made from."""
    silver = flow.upstream(lake.SILVER, watermark=False).unionByName(flow.upstream(lake.SILVER_LATE, watermark=False))
    return keep_partials(silver, flow.root, flow.checkpoint("partials"), trigger)


def append_lost_quotes(flow: Flow) -> DataFrame:
    """Batch: the accepted quotes that the Silver stream left behind its watermark, written beside
    it under ``silver/quotes_late`` in Silver's layout; returns all of them.

    Judged are the Bronze files of Silver's finished batches, no others: what Silver has still
    to read is not late. Each file is judged once; a mark beside the checkpoints says how
    far that went. A run that broke off is repeated: quotes it had kept are not lost any
    more. Silver is asked about the trade dates of these rows only.
    """
    spark, checkpoint = flow.spark, flow.checkpoint("silver")
    ensure_table(spark, flow.root, lake.SILVER_LATE, flow.fmt)
    upto = finished_entry(spark, checkpoint)
    if upto != NOTHING:
        marks = f"{flow.checkpoint('late')}/{stream_id(spark, checkpoint)}"
        after = max((int(name.rsplit("/", 1)[-1]) for name in files.names(spark, f"{marks}/*")), default=NOTHING)
        if upto > after:
            bronze = unjudged_bronze(flow, after, upto)
            dates = _distinct_days(bronze, F.date_format(event_time(F.col("regularMarketTime")), "yyyy-MM-dd"))
            known = on_days(lake.all_silver(spark, flow.root, flow.fmt), "trade_date", dates)
            lake.write_table(lost_quotes(bronze, known, flow.clocks.silver), flow.root, lake.SILVER_LATE, flow.fmt)
            files.create_text(spark, f"{marks}/{upto:012d}", "")
    return lake.read_table(spark, flow.root, lake.SILVER_LATE, flow.fmt)


def vacuum_gold(flow: Flow, keep: int = 2) -> int:
    """Removes the snapshots of both Gold tables and of the partials that the last ``keep``
    manifests do not name; returns their number."""
    return vacuum_partials(flow.spark, flow.root, keep) + sum(len(snapshots.vacuum(flow.spark, lake.location(flow.root, spec), keep))
               for spec in lake.TABLES if spec.snapshots)


def start_edge(flow: Flow, responses: DataFrame,
               publish: Callable[[DataFrame, str], DataStreamWriter],
               trigger: dict | None = None) -> list[StreamingQuery]:
    """Raw responses (ticker, body) through the gate: accepted ones to the topic, refused
    ones with their cause to ``edge/refused``. ``publish`` makes the topic's writer from the
    messages and a checkpoint, as ``sources.kafka`` does."""
    gated = edge.gate(responses)
    sent = publish(edge.publishable(gated), flow.checkpoint("published")).queryName("published")
    held = edge.refused(gated).writeStream.format(flow.fmt).outputMode("append").queryName(
        "refused").option("checkpointLocation", flow.checkpoint("refused"))
    if trigger:
        sent, held = sent.trigger(**trigger), held.trigger(**trigger)
    return [sent.start(), held.start(f"{flow.root.rstrip('/')}/edge/refused")]


def drain(*starts: Callable[[], StreamingQuery]) -> list[StreamingQuery]:
    """Start the given jobs together and wait for all of them."""
    running = [start() for start in starts]
    for query in running:
        query.awaitTermination()
    return running


def catch_up(flow: Flow, messages: DataFrame) -> dict[str, StreamingQuery]:
    """Carry everything available through all layers once, then stop.

    Each layer starts after its upstream has finished; siblings run side by side.
    """
    now = ALL_AVAILABLE
    done = [
        *drain(lambda: start_bronze(flow, messages, now)),
        *drain(lambda: start_silver(flow, now), lambda: start_quarantine(flow, now)),
        *drain(lambda: start_gold_operational(flow, now),
               lambda: start_gold_financial(flow, now)),
    ]
    return dict(zip(("bronze", "silver", "quarantine", "gold_operational", "gold_financial"),
                    done))
