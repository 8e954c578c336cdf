"""Structured log lines as data: topics, alerts, routes, cycles, credential scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.times import seconds_between
from quotelake.schema import POLL_MINUTES

# The fields and event names written by the collectors.
LOG_SCHEMA = (
    "timestamp string, level string, service string, event string, message string, "
    "ticker string, topic string, status_code int, endpoint string, "
    "endpoint_versao string, duracao_ms double, sucessos bigint, falhas bigint, erro string"
)
TOPIC_EVENTS = {
    "source_calls": (
        "brapi_request_succeeded", "brapi_request_failed", "brapi_fallback_legacy_endpoint",
        "brapi_invalid_json", "brapi_schema_validation_failed",
    ),
    "publish": (
        "kafka_publish_succeeded", "kafka_publish_failed", "kafka_publish_unexpected_error",
    ),
    "scheduler": (
        "scheduler_started", "scheduler_cycle_started", "ticker_collection_succeeded",
        "ticker_collection_failed", "ticker_collection_unexpected_error",
        "scheduler_cycle_finished", "scheduler_cycle_overrun",
    ),
    "layout_checks": ("delta_table_schema_compatible", "delta_table_schema_incompatible"),
}
SOURCE_CALL_OK = "brapi_request_succeeded"
SOURCE_CALL_FAILED = "brapi_request_failed"
LAYOUT_FITS, LAYOUT_DIFFERS = TOPIC_EVENTS["layout_checks"]
COLLECTED = "ticker_collection_succeeded"
NOT_COLLECTED = ("ticker_collection_failed", "ticker_collection_unexpected_error")
CYCLE_FINISHED = "scheduler_cycle_finished"
ALERT_LEVELS = ("WARNING", "ERROR")
SECRET_MARK = "token="


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """Text lines (``value``) to columns; any prefix before the JSON object is ignored.

    Lines without a readable object are kept with null fields; other input columns stay.
    ``log_time`` is the parsed timestamp.
    """
    start = F.instr("value", "{")
    document = F.when(start > 0, F.substring(F.col("value"), start, F.length("value")))
    # Behind a generator, so that a filter on a field does not parse the line again.
    return (
        lines.select("*", F.inline(F.array(F.from_json(document, LOG_SCHEMA))))
        .withColumnRenamed("value", "line")
        .withColumn("log_time", F.try_to_timestamp("timestamp"))
    )


def by_topic(entries: DataFrame) -> DataFrame:
    """Entries that belong to a topic, labelled ``log_topic``; ready for partitionBy."""
    label = F.lit(None).cast("string")
    for topic, events in TOPIC_EVENTS.items():
        label = F.when(F.col("event").isin(*events), topic).otherwise(label)
    return entries.withColumn("log_topic", label).filter(F.col("log_topic").isNotNull())


def alerts(entries: DataFrame) -> DataFrame:
    """Warnings and errors."""
    return entries.filter(F.col("level").isin(*ALERT_LEVELS))


def route_counts(entries: DataFrame) -> DataFrame:
    """Successful source calls per endpoint version."""
    return (
        entries.filter(F.col("event") == SOURCE_CALL_OK)
        .groupBy(F.col("endpoint_versao").alias("endpoint_version"))
        .agg(F.count(F.lit(1)).alias("calls"))
        .orderBy(F.desc("calls"), "endpoint_version")
    )


def recent_calls(entries: DataFrame, now: Column, minutes: int = POLL_MINUTES) -> DataFrame:
    """Source calls of the last minutes per endpoint version: successes, failures and the mean
    time of a call. A line stamped after ``now`` does not count."""
    since = F.col("log_time") > now - F.make_dt_interval(mins=F.lit(minutes))
    return (
        entries.filter(F.col("event").isin(SOURCE_CALL_OK, SOURCE_CALL_FAILED)
                       & since & (F.col("log_time") <= now))
        .groupBy(F.col("endpoint_versao").alias("endpoint_version"))
        .agg(F.count_if(F.col("event") == SOURCE_CALL_OK).alias("successes"),
             F.count_if(F.col("event") == SOURCE_CALL_FAILED).alias("failures"),
             F.round(F.avg("duracao_ms"), 2).alias("avg_ms"))
        .orderBy("endpoint_version")
    )


def _overran(minutes: int) -> Column:
    return (F.col("event") == CYCLE_FINISHED) & (F.col("duracao_ms") > minutes * 60_000)


def cycles(entries: DataFrame, minutes: int = POLL_MINUTES) -> DataFrame:
    """Collections per polling cycle: successes, failures, time from first to last.

    Cycles start on multiples of the interval, so each is one tumbling window. It
    overran when the scheduler reports a duration above the interval.
    """
    collection = F.col("event").isin(COLLECTED, *NOT_COLLECTED)
    when = F.when(collection, F.col("log_time"))
    return (
        entries.filter((collection | (F.col("event") == CYCLE_FINISHED))
                       & F.col("log_time").isNotNull())
        .groupBy(F.window("log_time", f"{minutes} minutes").alias("cycle"))
        .agg(
            F.count_if(F.col("event") == COLLECTED).alias("successes"),
            F.count_if(F.col("event").isin(*NOT_COLLECTED)).alias("failures"),
            F.min(when).alias("first_log"),
            F.max(when).alias("last_log"),
            F.round(F.sum(F.when(collection, F.col("duracao_ms"))), 2).alias("collecting_ms"),
            (F.count_if(_overran(minutes)) > 0).alias("overran"),
        )
        .select(
            F.col("cycle.start").alias("cycle_start"), "successes", "failures",
            seconds_between("first_log", "last_log").alias("span_s"),
            "collecting_ms", "overran")
        .orderBy("cycle_start")
    )


def overruns(entries: DataFrame, minutes: int = POLL_MINUTES) -> DataFrame:
    """Finished scheduler cycles that took longer than the interval."""
    return entries.filter(_overran(minutes)).select(
        "log_time", "sucessos", "falhas", "duracao_ms")


def secret_lines(lines: DataFrame, mark: str = SECRET_MARK) -> DataFrame:
    """Lines that carry a credential; none are expected."""
    return lines.filter(F.col("value").contains(mark))
