"""Every operator as a named query over a folder of source tables."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions.columns import keep_where
from quotelake.operators import edge, logs, measures, series
from quotelake.operators.bronze import to_bronze
from quotelake.operators.gold import to_gold, to_gold_financial, to_gold_operational
from quotelake.operators.quarantine import reason_codes, row_accounting, to_quarantine
from quotelake.operators.silver import to_silver, typed_quotes
from quotelake.plans.build import build_lake
from quotelake.plans.catalogue import catalogue
from quotelake.plans.dashboard import kept_panels, panels, score_panels
from quotelake.plans.report import export_report, sections
from quotelake.plans.window import ReportWindow, session_windows
from quotelake.schema import (
    BRONZE_COLUMNS, EDGE_FLAG_FIELDS, EDGE_TEXT_FIELDS, MESSAGE_SCHEMA, NUMBER_FIELDS, SILVER_COLUMNS,
    TEXT_FIELDS, WHOLE_FIELDS,
)
from quotelake.session import configure, shared_dir
from quotelake.sources import from_events as source
from quotelake.sources import lake
from quotelake.sources.kafka import message_files_sink, message_files_stream
from quotelake.sources.log_files import read_log_lines, start_topic_tables, stream_log_lines
from quotelake.sources.layout import (
    layout_differences, planned_layout, stored_file_layout,
)
from quotelake.streaming import jobs
from quotelake.streaming.partials import keep_partials, open_partials
from quotelake.streaming.sinks import ALL_AVAILABLE, ensure_table, gold_stream, write_gold

Query = Callable[[SparkSession, str], DataFrame]

# The five symbols of the events table and one that never sends anything.
TICKERS = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW", "MISSING1")
# Both bounds lie inside the data, so that a window that cut nothing would show.
REPORT_WINDOW = ReportWindow.local("2024-01-08 09:45", "2024-01-20 18:00")
NOW = datetime(2024, 1, 30, 12, tzinfo=timezone.utc)
NOW_HALF = datetime(2024, 1, 16, tzinfo=timezone.utc)
NOW_LATER = datetime(2024, 1, 23, tzinfo=timezone.utc)
EXPORT_DAY = "2024-01-10"

_stored: dict[tuple, str] = {}
_opened: dict[str, lake.Lake] = {}
_lock = threading.RLock()


def naive(df: DataFrame) -> DataFrame:
    """Timestamps without a zone (UTC), as the source tables have them."""
    return df.select(*[
        F.col(f"`{field.name}`").cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.TimestampType) else F.col(f"`{field.name}`")
        for field in df.schema])


def even_average(gold: DataFrame) -> DataFrame:
    """Averages to six decimals: the order of a double sum is not fixed."""
    return gold.withColumn("avg_price", F.round("avg_price", 6))


def _version(spark: SparkSession, sf_dir: str) -> int:
    """Identity of the events files: names, sizes and times, not their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        f"{sf_dir}/events.parquet").select("path", "length", "modificationTime")
    return files.agg(F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()[0]


def _place(spark: SparkSession, sf_dir: str, kind: str,
           make: Callable[[str], None]) -> str:
    """Folder with data made once per session and version of the source table."""
    with _lock:
        key = (spark.sparkContext.applicationId, kind, _version(spark, sf_dir))
        if key not in _stored:
            root = (f"{shared_dir(spark)}/quotelake/{key[0]}/{kind}"
                    f"_{abs(hash(key[2])):x}_{len(_stored)}")
            make(root)
            _stored[key] = root
        return _stored[key]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.read_events(configure(spark), sf_dir)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.quote_messages(_events(spark, sf_dir))


def _stored_messages(spark: SparkSession, sf_dir: str) -> str:
    """Message files, made once for all lakes that read them in parts or as a stream."""
    return _place(spark, sf_dir, "messages", lambda root: _messages(spark, sf_dir).write.parquet(root))


def _bronze_part(spark: SparkSession, sf_dir: str, part: Callable[[Column], Column]) -> DataFrame:
    """Bronze of the stored messages for which ``part`` of their arrival holds; no others are parsed."""
    messages = spark.read.schema(MESSAGE_SCHEMA).parquet(_stored_messages(spark, sf_dir))
    return to_bronze(messages.filter(part(F.col("timestamp"))), source.ingest_clock())


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(_messages(spark, sf_dir), source.ingest_clock())


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(_bronze(spark, sf_dir), clock=source.silver_clock())


def lake_root(spark: SparkSession, sf_dir: str) -> str:
    """The five tables of this source folder, refined in batch on first use."""
    configure(spark)
    return _place(spark, sf_dir, "lake", lambda root: build_lake(
        spark, _messages(spark, sf_dir), root, bronze_clock=source.ingest_clock(),
        silver_clock=source.silver_clock(), gold_clock=source.gold_clock()))


def _lake(spark: SparkSession, sf_dir: str) -> lake.Lake:
    root = lake_root(spark, sf_dir)
    with _lock:
        # The tables no longer change: their file listing is read once.
        if root not in _opened:
            _opened[root] = lake.open_lake(spark, root)
        return _opened[root]


def stream_root(spark: SparkSession, sf_dir: str) -> str:
    """The tables written by the streaming Bronze, Silver and quarantine jobs."""
    configure(spark)

    def run(root: str) -> None:
        clocks = jobs.Clocks(source.ingest_clock(), source.silver_clock())
        flow = jobs.Flow(spark, root, f"{root}/checkpoints", clocks=clocks)
        messages = message_files_stream(spark, _stored_messages(spark, sf_dir))
        jobs.drain(lambda: jobs.start_bronze(flow, messages, ALL_AVAILABLE))
        jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE),
                   lambda: jobs.start_quarantine(flow, ALL_AVAILABLE))
    return _place(spark, sf_dir, "stream", run)


def _streamed(spec: lake.TableSpec, without: tuple[str, ...] = ()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return naive(lake.read_table(spark, stream_root(spark, sf_dir), spec).drop(*without))
    return query


def _gold_streamed(mode: str, spec: lake.TableSpec, refine: Callable) -> Query:
    """A Gold job fed by the stored Silver table as a stream."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = lake.stream_table(spark, lake_root(spark, sf_dir), lake.SILVER)

        def run(root: str) -> None:
            gold = refine(silver, clock=source.gold_clock())
            gold_stream(gold, root, spec, f"gold_{mode}", f"{root}/checkpoints", mode,
                        ALL_AVAILABLE).awaitTermination()
        root = _place(spark, sf_dir, f"gold_{mode}_{spec.name}", run)
        return naive(even_average(lake.read_table(spark, root, spec)))
    return query


def _audit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored Bronze and quarantine rows whose audit text is the message as it was sent."""
    root = stream_root(spark, sf_dir)
    sent = spark.read.schema(MESSAGE_SCHEMA).parquet(_stored_messages(spark, sf_dir)).select(
        "offset", F.sha2("value", 256).alias("sent"))
    parts = [
        lake.read_table(spark, root, spec).select(
            "offset", F.sha2("raw_json", 256).alias("kept"), F.lit(spec.name).alias("table_name"))
        for spec in (lake.BRONZE, lake.QUARANTINE)]
    return _union(parts).join(sent, "offset").groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("kept") == F.col("sent")).alias("unchanged"))


def _halves_root(spark: SparkSession, sf_dir: str) -> str:
    """Silver streamed from Bronze whose later half arrived first, so that the watermark
    leaves the earlier half behind, and the quotes so lost kept beside it."""
    configure(spark)

    def run(root: str) -> None:
        clocks = jobs.Clocks(source.ingest_clock(), source.silver_clock())
        flow = jobs.Flow(spark, root, f"{root}/checkpoints", clocks=clocks)
        for part in (lambda arrival: arrival >= F.lit(NOW_HALF), lambda arrival: arrival < F.lit(NOW_HALF)):
            lake.write_table(_bronze_part(spark, sf_dir, part), root, lake.BRONZE)
            jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
        jobs.append_lost_quotes(flow)
    return _place(spark, sf_dir, "halves", run)


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_table(spark, _halves_root(spark, sf_dir))


def _by_table(spark: SparkSession, root: str) -> DataFrame:
    """Which table each quote of a streamed Silver is in."""
    shown = [c for c in SILVER_COLUMNS if c not in ("kafka_time", "ingest_time", "silver_time")]
    parts = [lake.read_table(spark, root, spec).select(*shown, F.lit(late).alias("late"))
             for spec, late in ((lake.SILVER, False), (lake.SILVER_LATE, True))]
    return naive(_union(parts))


def _while_running_root(spark: SparkSession, sf_dir: str) -> str:
    """Layers of a lake in which the late job runs while Bronze is ahead of Silver.

    Bronze gets its third quarter, then its last one, then the earlier half, which is late.
    Before Silver reads a part the late job runs, and again behind it, twice at the end.
    """
    configure(spark)

    def run(root: str) -> None:
        clocks = jobs.Clocks(source.ingest_clock(), source.silver_clock(), source.gold_clock())
        flow = jobs.Flow(spark, root, f"{root}/checkpoints", clocks=clocks)
        parts = [lambda arrival: (arrival >= F.lit(NOW_HALF)) & (arrival < F.lit(NOW_LATER)),
                 lambda arrival: arrival >= F.lit(NOW_LATER), lambda arrival: arrival < F.lit(NOW_HALF)]
        for part in parts:
            lake.write_table(_bronze_part(spark, sf_dir, part), root, lake.BRONZE)
            jobs.append_lost_quotes(flow)
            jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
        jobs.drain(lambda: jobs.start_gold_financial(flow, ALL_AVAILABLE))
        for _ in range(2):
            jobs.append_lost_quotes(flow)
        jobs.drain(lambda: jobs.start_gold_financial(flow, ALL_AVAILABLE))
    return _place(spark, sf_dir, "while_running", run)


def _late_while_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_table(spark, _while_running_root(spark, sf_dir))


def _gold_with_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of that lake: windows count late quotes, whose Silver stream had let them go."""
    return naive(even_average(lake.read_table(spark, _while_running_root(spark, sf_dir), lake.GOLD_FINANCIAL)))


def _backfilled(survivor: str, without: tuple[str, ...] = ()) -> Query:
    """Silver from a stored Bronze backlog, five days a batch."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        def run(root: str) -> None:
            clocks = jobs.Clocks(source.ingest_clock(), source.silver_clock())
            flow = jobs.Flow(spark, root, f"{root}/checkpoints", clocks=clocks, survivor=survivor)
            lake.write_table(_bronze(spark, sf_dir), root, lake.BRONZE)
            jobs.backfill_silver(flow, 5)
        configure(spark)
        root = _place(spark, sf_dir, f"backfill_{survivor}", run)
        return naive(lake.read_table(spark, root, lake.SILVER).drop(*without))
    return query


def _gold_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered Gold table that was written three times and cleared of older snapshots, as any
    reader of the catalog sees it."""
    silver = _lake(spark, sf_dir).silver

    def run(root: str) -> None:
        for spec in lake.TABLES:
            ensure_table(spark, root, spec)
        prefix = _prefix(root)
        lake.register_tables(spark, root, prefix=prefix)
        for batch, part in enumerate((F.col("kafka_time") < F.lit(NOW_HALF), F.col("kafka_time") < F.lit(NOW_LATER),
                                      F.lit(True))):
            gold = to_gold_financial(silver.filter(part), clock=source.gold_clock())
            write_gold(gold, batch, root, lake.GOLD_FINANCIAL, "complete", "registered", prefix)
        jobs.vacuum_gold(jobs.Flow(spark, root, f"{root}/checkpoints"), keep=1)
    root = _place(spark, sf_dir, "gold_registered", run)
    stored = spark.table(lake.qualified(lake.GOLD_FINANCIAL, _prefix(root)))
    return naive(even_average(stored.select(*lake.GOLD_FINANCIAL.columns)))


def _prefix(root: str) -> str:
    return f"lake_{abs(hash(root)):x}_"


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every section of an exported report, read back."""
    tables = lake_root(spark, sf_dir)

    def run(root: str) -> None:
        lake.register_tables(spark, tables, prefix=_prefix(tables))
        export_report(spark, EXPORT_DAY, root, prefix=_prefix(tables), tickers=TICKERS)
    root = _place(spark, sf_dir, "export", run)
    return _union([
        spark.read.parquet(f"{root}/{title.replace(' ', '_')}").agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(title).alias("section"), "rows") for title in ("00 window", *_REPORT.values())])


def _edge_root(spark: SparkSession, sf_dir: str) -> str:
    """Responses as files, streamed through the gate to message files and refused rows."""
    configure(spark)

    def run(root: str) -> None:
        source.raw_responses(_events(spark, sf_dir)).write.parquet(f"{root}/responses")
        responses = spark.readStream.schema("event_id long, ticker string, body string").parquet(
            f"{root}/responses")
        flow = jobs.Flow(spark, root, f"{root}/checkpoints")
        for query in jobs.start_edge(flow, responses, message_files_sink(f"{root}/topic", "quotes"),
                                     ALL_AVAILABLE):
            query.awaitTermination()
    return _place(spark, sf_dir, "edge", run)


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages on the topic, per key and text."""
    sent = spark.read.schema(MESSAGE_SCHEMA).parquet(f"{_edge_root(spark, sf_dir)}/topic")
    return _message_shape(sent).groupBy("key", "quotes", "fields", "took").agg(
        F.count(F.lit(1)).alias("messages"))


def _refused_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = spark.read.parquet(f"{_edge_root(spark, sf_dir)}/edge/refused")
    return held.select("event_id", "key", "gate_status")


def _message_shape(messages: DataFrame) -> DataFrame:
    shape = F.from_json("value", "results array<map<string,string>>, took int")
    return messages.select("*", shape.alias("m")).select(
        *[c for c in messages.columns if c in ("event_id", "key")], F.size("m.results").alias("quotes"),
        F.size(F.col("m.results")[0]).alias("fields"), F.col("m.took").alias("took"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to five-minute price windows by quote time."""
    gold = to_gold_financial(_silver(spark, sf_dir), clock=source.gold_clock())
    return naive(even_average(gold))


def _layers() -> dict[str, Query]:
    bronze_shown = [c for c in BRONZE_COLUMNS if c != "raw_json"]
    return {
        "bronze_parse": lambda s, d: naive(_bronze(s, d).select(*bronze_shown)),
        "bronze_status_counts": lambda s, d: _bronze(s, d).groupBy("parse_status").agg(
            F.count(F.lit(1)).alias("rows")),
        "bronze_explode": lambda s, d: _bronze(s, d).groupBy("offset").agg(
            F.count(F.lit(1)).alias("rows"), F.count("shortName").alias("quotes")),
        "bronze_bare_messages": lambda s, d: naive(to_bronze(
            _messages(s, d).select("timestamp", "value"), F.col("kafka_time"),
        ).select("topic", "partition", "offset", "key", "kafka_time", "parse_status",
                 "ingest_time", "symbol", "regularMarketPrice")),
        "silver_typed": lambda s, d: naive(
            typed_quotes(_bronze(s, d), source.silver_clock()).select(*SILVER_COLUMNS)),
        "silver_clean": lambda s, d: naive(_silver(s, d)),
        "silver_strict": lambda s, d: naive(to_silver(
            _bronze(s, d), clock=source.silver_clock(), strict_parse=True)),
        "silver_dedup": lambda s, d: naive(
            _silver(s, d).select("symbol", "quote_time", "price", "kafka_time")),
        "silver_partitions": lambda s, d: measures.partition_rows(_silver(s, d)),
        "quarantine_rows": lambda s, d: naive(to_quarantine(_bronze(s, d)).drop("raw_json")),
        "quarantine_reasons": lambda s, d: measures.reject_counts(to_quarantine(_bronze(s, d))),
        "quarantine_reason_codes": lambda s, d: reason_codes(to_quarantine(_bronze(s, d))),
        "row_accounting": lambda s, d: row_accounting(_bronze(s, d)),
        "gold_operational": lambda s, d: naive(even_average(
            to_gold_operational(_silver(s, d), clock=source.gold_clock()))),
        "gold_financial": flagship,
        "gold_default": lambda s, d: naive(even_average(
            to_gold(_silver(s, d), clock=source.gold_clock()))),
    }


def _streams() -> dict[str, Query]:
    return {
        "stream_bronze": _streamed(lake.BRONZE, ("raw_json",)),
        "stream_audit_texts": _audit_texts,
        # Which of two copies of a quote survives a stream is open, hence no clocks.
        "stream_silver": _streamed(lake.SILVER, ("kafka_time", "ingest_time", "silver_time")),
        "stream_quarantine": _streamed(lake.QUARANTINE, ("raw_json",)),
        "stream_silver_reconciled": _reconciled,
        "stream_late_while_running": _late_while_running,
        "stream_silver_by_day": _backfilled("seen", ("kafka_time", "ingest_time", "silver_time")),
        # The copy that a batch keeps, so all clocks are compared; quotes that the watermark has not
        # passed at the end are still held.
        "stream_silver_earliest": _backfilled("earliest"),
        "gold_stream_with_late": _gold_with_late,
        "gold_registered": _gold_registered,
        "stream_published": _published,
        "stream_refused": _refused_stream,
        "gold_stream_complete": _gold_streamed(
            "complete", lake.GOLD_OPERATIONAL, to_gold_operational),
        "gold_stream_complete_financial": _gold_streamed(
            "complete", lake.GOLD_FINANCIAL, to_gold_financial),
        "gold_stream_update": _gold_streamed(
            "update", lake.GOLD_FINANCIAL, to_gold_financial),
        "gold_stream_append": _gold_streamed(
            "append", lake.GOLD_FINANCIAL, to_gold_financial),
    }


# Query name -> section title.
_REPORT = {
    "report_01_overview": "01 overview",
    "report_02_throughput": "02 throughput",
    "report_03_prices": "03 prices by symbol",
    "report_04a_bronze_quality": "04a bronze quality",
    "report_04b_silver_quality": "04b silver quality",
    "report_04c_rejects": "04c rejected rows",
    "report_04d_repeats": "04d repeated quotes",
    "report_05_span": "05 observed span",
    "report_06_stage_latency": "06 stage latency",
    "report_07_recent": "07 recent samples",
    "report_08_partitions": "08 partitions",
    "report_09_gold_operational": "09 gold operational",
    "report_10_gold_financial": "10 gold financial",
    "report_11_percentiles": "11 latency percentiles",
    "report_12_source_lag": "12 source lag",
    "report_13_scores": "13 quality scores",
    "report_14_coverage": "14 coverage",
    "report_15_gaps": "15 gaps",
}
_CATALOGUE = (
    "bronze_quality", "silver_quality", "silver_rejects", "bronze_repeats", "stage_latency",
    "latency_percentiles", "recent_latency", "gold_recompute", "gold_financial",
    "silver_throughput", "coverage_24h", "gaps_24h",
)
_PANELS = (
    "overall_score", "validity", "completeness", "freshness", "latency",
    "messages_per_minute", "latest_quotes", "latency_series",
)


# Panels and catalogue measures that are made from partial aggregates.
_KEPT_PANELS = _PANELS
_KEPT_METRICS = ("silver_quality", "stage_latency", "latency_percentiles", "silver_throughput")


def _kept(name: str) -> Query:
    """A panel from partials that a stream over the stored Silver table has kept, eight files a batch."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = lake.stream_table(spark, lake_root(spark, sf_dir), lake.SILVER, max_files_per_trigger=8)
        root = _place(spark, sf_dir, "partials", lambda root: keep_partials(
            silver, root, f"{root}/checkpoint", ALL_AVAILABLE).awaitTermination())
        return naive(kept_panels(open_partials(spark, root), F.lit(NOW))[name]())
    return query


def _shown(df: DataFrame) -> DataFrame:
    return naive(even_average(df) if "time_basis" in df.columns and "avg_price" in df.columns
                 else df)


def _reports() -> dict[str, Query]:
    def section(title: str) -> Query:
        return lambda s, d: _shown(sections(_lake(s, d), REPORT_WINDOW, TICKERS)[title]())

    def metric(name: str) -> Query:
        return lambda s, d: _shown(catalogue(_lake(s, d), NOW, TICKERS)[name]())

    def panel(name: str) -> Query:
        return lambda s, d: naive(panels(_lake(s, d).silver, F.lit(NOW))[name]())

    return {
        "report_00_window": lambda s, d: naive(
            session_windows(_lake(s, d).bronze, len(TICKERS))),
        **{name: section(title) for name, title in _REPORT.items()},
        **{f"catalogue_{name}": metric(name) for name in _CATALOGUE},
        "gaps_all": lambda s, d: naive(series.message_gaps(_lake(s, d).bronze, limit=None)),
        **{f"dashboard_{name}": panel(name) for name in _PANELS},
        **{f"kept_{name}": _kept(name) for name in (*_KEPT_PANELS, *_KEPT_METRICS)},
        "report_export": _exported,
        "dashboard_scores": lambda s, d: naive(score_panels(_lake(s, d).silver, F.lit(NOW))),
    }


def _edge() -> dict[str, Query]:
    def responses(s: SparkSession, d: str) -> DataFrame:
        return source.raw_responses(_events(s, d))

    def checked(s: SparkSession, d: str) -> DataFrame:
        return edge.check_contract(edge.normalise_payloads(responses(s, d)))

    def normalised(s: SparkSession, d: str) -> DataFrame:
        results = edge.normalise_payloads(responses(s, d)).select(
            "event_id", F.explode("results").alias("result"))
        return results.selectExpr(
            "event_id", "schema_of_variant(result) LIKE 'OBJECT%' AS is_object",
            "try_variant_get(result, '$.symbol', 'string') AS symbol",
            "try_variant_get(result, '$.regularMarketPrice', 'double') AS price",
            "try_variant_get(result, '$.data', 'variant') IS NOT NULL AS still_nested")

    def payload(s: SparkSession, d: str) -> DataFrame:
        types = {**{f: "string" for f in TEXT_FIELDS + EDGE_TEXT_FIELDS}, **{f: "double" for f in NUMBER_FIELDS},
                 **{f: "bigint" for f in WHOLE_FIELDS}, **{f: "boolean" for f in EDGE_FLAG_FIELDS}}
        quote = f"array<struct<{', '.join(f'{f}:{kind}' for f, kind in types.items())}>>"
        published = keep_where(
            edge.project_contract(checked(s, d)), F.col("contract_status") == edge.ACCEPTED)
        return published.select(
            "event_id", F.explode(F.from_json("value", f"results {quote}")["results"]).alias("q")
        ).select("event_id", "q.*")

    def messages(s: SparkSession, d: str) -> DataFrame:
        ready = keep_where(edge.gate(responses(s, d)), F.col("gate_status") == edge.ACCEPTED)
        return _message_shape(ready)

    return {
        "edge_ticker": lambda s, d: edge.check_tickers(responses(s, d)).select(
            "event_id", "key", "ticker_valid"),
        "edge_normalise": normalised,
        "edge_contract": lambda s, d: checked(s, d).select("event_id", "contract_status"),
        "edge_payload": payload,
        "edge_refused": lambda s, d: edge.refused(edge.gate(responses(s, d))).select(
            "event_id", "key", "gate_status"),
        "publish_messages": messages,
    }


def _catalog() -> dict[str, Query]:
    def registered(s: SparkSession, d: str) -> DataFrame:
        root = lake_root(s, d)
        prefix = _prefix(root)
        names = lake.register_tables(s, root, prefix=prefix)
        counts = [s.table(name).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name.removeprefix(prefix)).alias("table_name"), "rows") for name in names]
        return _union(counts)

    def guarded(s: SparkSession, d: str) -> DataFrame:
        root = lake_root(s, d)
        rows = []
        for spec in lake.TABLES:
            stored = stored_file_layout(s, root, spec)
            order = sorted((p.partition, c) for c, p in stored.items() if p.partition)
            found = layout_differences(stored, planned_layout(spec))
            rows.append(lake.read_table(s, root, spec).agg(F.count(F.lit(1)).alias("rows"))
                        .select(F.lit(spec.path).alias("table_path"),
                                F.lit(",".join(c for _, c in order)).alias("partitions"),
                                F.lit(len(found)).alias("differences"), "rows"))
        return _union(rows)

    def mismatched(s: SparkSession, d: str) -> DataFrame:
        """What tells Bronze from the layout of quarantine, with the rows it is about."""
        root = lake_root(s, d)
        found = layout_differences(stored_file_layout(s, root, lake.BRONZE), planned_layout(lake.QUARANTINE))
        listed = F.array(*[F.struct(*[
            F.lit(text).cast("string").alias(name) for name, text in zip(("column", "stored", "planned"), row)])
            for row in found])
        return lake.read_table(s, root, lake.BRONZE).agg(F.count(F.lit(1)).alias("rows")).select(
            F.explode(listed).alias("found"), "rows").select("found.*", "rows")

    def layer_days(s: SparkSession, d: str) -> DataFrame:
        return _union([lake.footer_counts(s, lake_root(s, d), spec) for spec in lake.TABLES])

    return {"layer_days": layer_days, "register_tables": registered, "layout_guard": guarded, "layout_mismatch": mismatched}


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _logs() -> dict[str, Query]:
    def lines(s: SparkSession, d: str) -> DataFrame:
        return source.log_lines(_events(s, d))

    def entries(s: SparkSession, d: str) -> DataFrame:
        return logs.parse_log_lines(lines(s, d))

    def files(s: SparkSession, d: str) -> str:
        """Log files, and the topic tables that a stream makes of them."""
        def run(root: str) -> None:
            lines(s, d).select("value").write.text(f"{root}/lines")
            start_topic_tables(stream_log_lines(s, f"{root}/lines"), f"{root}/topics", f"{root}/checkpoint",
                               ALL_AVAILABLE).awaitTermination()
        configure(s)
        return _place(s, d, "log_files", run)

    def topic_tables(s: SparkSession, d: str) -> DataFrame:
        root = files(s, d)
        kept = s.read.parquet(f"{root}/topics").groupBy("log_topic", "event").agg(F.count(F.lit(1)).alias("rows"))
        read = read_log_lines(s, f"{root}/lines").agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit("lines").alias("log_topic"), F.lit(None).cast("string").alias("event"), "rows")
        return _union([kept, read])

    return {
        "log_files": topic_tables,
        "log_topics": lambda s, d: logs.by_topic(entries(s, d)).select(
            "event_id", "event", "log_topic"),
        "log_alerts": lambda s, d: naive(logs.alerts(entries(s, d)).select(
            "event_id", "log_time", "level", "event", "ticker")),
        "log_route_counts": lambda s, d: logs.route_counts(entries(s, d)),
        "log_recent_calls": lambda s, d: logs.recent_calls(
            entries(s, d), F.lit(NOW), minutes=3 * 24 * 60),
        "log_cycles": lambda s, d: naive(logs.cycles(entries(s, d))),
        "log_overruns": lambda s, d: naive(logs.overruns(entries(s, d))),
        "log_secrets": lambda s, d: logs.secret_lines(lines(s, d)).select("event_id"),
    }


def queries() -> dict[str, Query]:
    """Query name -> job over (session, source folder)."""
    return {**_layers(), **_streams(), **_reports(), **_edge(), **_catalog(), **_logs()}
