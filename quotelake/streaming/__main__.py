"""Runs one job: ``python -m quotelake.streaming bronze --root … --checkpoints …``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quotelake.operators.silver import SURVIVORS
from quotelake.session import configure
from quotelake.sources.kafka import (
    kafka_stream, message_files_sink, message_files_stream, topic_sink,
)
from quotelake.streaming import jobs
from quotelake.streaming.sinks import ALL_AVAILABLE, GOLD_MODES, ProgressLog

STARTS = {
    "silver": jobs.start_silver,
    "quarantine": jobs.start_quarantine,
    "gold_operational": jobs.start_gold_operational,
    "gold_financial": jobs.start_gold_financial,
    "partials": jobs.start_partials,
}


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quotelake.streaming")
    parser.add_argument("job", choices=["edge", "bronze", *STARTS, "late", "backfill", "vacuum"])
    parser.add_argument("--root", required=True, help="folder of the lake tables")
    parser.add_argument("--checkpoints", required=True, help="folder of offsets and state")
    parser.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    parser.add_argument("--servers", help="Kafka bootstrap servers (edge, bronze)")
    parser.add_argument("--topic", default="cotacoes", help="Kafka topic (edge, bronze)")
    parser.add_argument("--files", help="folder of message files instead of Kafka (edge, bronze)")
    parser.add_argument("--responses", help="folder of raw responses, JSON lines (edge)")
    parser.add_argument("--checks", help="folder that gets a log line for every layout check")
    parser.add_argument("--progress", help="folder that gets a line for every batch")
    parser.add_argument("--max-offsets", type=int, help="messages per batch (bronze)")
    parser.add_argument("--max-files", type=int, help="files per batch (bronze, quarantine)")
    parser.add_argument("--days", type=int, default=1, help="days of Bronze per batch (backfill)")
    parser.add_argument("--survivor", default="seen", choices=SURVIVORS, help="copy that is kept (silver)")
    parser.add_argument("--registered", help="prefix of the catalog schemas that Gold is registered in")
    parser.add_argument("--gold-mode", default="complete", choices=GOLD_MODES)
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    options = parser.parse_args(given)
    if options.job in ("edge", "bronze") and not (options.servers or options.files):
        parser.error(f"{options.job} needs --servers or --files")
    if options.job == "edge" and not options.responses:
        parser.error("edge needs --responses")
    if options.max_files and options.job not in ("bronze", "quarantine"):
        parser.error("--max-files loses rows in front of a watermark")
    return options


def flow_of(spark: SparkSession, options: argparse.Namespace) -> jobs.Flow:
    return jobs.Flow(spark, options.root, options.checkpoints, options.format,
                     max_files_per_trigger=options.max_files, gold_mode=options.gold_mode,
                     checks=options.checks, survivor=options.survivor, registered=options.registered)


def start(spark: SparkSession, options: argparse.Namespace):
    flow = flow_of(spark, options)
    trigger = {"trigger": ALL_AVAILABLE} if options.once else {}
    if options.progress:
        spark.streams.addListener(ProgressLog(spark, options.progress))
    if options.job == "edge":
        responses = spark.readStream.schema("ticker string, body string").json(options.responses)
        sink = (message_files_sink(options.files, options.topic) if options.files
                else topic_sink(options.servers, options.topic))
        return jobs.start_edge(flow, responses, sink, **trigger)
    if options.job != "bronze":
        return [STARTS[options.job](flow, **trigger)]
    messages = (
        message_files_stream(spark, options.files, max_files_per_trigger=options.max_files)
        if options.files else
        kafka_stream(spark, options.servers, options.topic,
                     max_offsets_per_trigger=options.max_offsets))
    return [jobs.start_bronze(flow, messages, **trigger)]


if __name__ == "__main__":
    chosen = arguments()
    session = configure(SparkSession.builder.appName(f"quotelake-{chosen.job}").getOrCreate())
    if chosen.job == "late":
        print(jobs.append_lost_quotes(flow_of(session, chosen)).count(), "late quotes kept")
    elif chosen.job == "backfill":
        print(jobs.backfill_silver(flow_of(session, chosen), chosen.days), "runs over Bronze")
    elif chosen.job == "vacuum":
        print(jobs.vacuum_gold(flow_of(session, chosen)), "snapshots removed")
    else:
        for query in start(session, chosen):
            query.awaitTermination()
