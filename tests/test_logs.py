"""Log lines as data."""

import json

from quotelake.operators import logs


def entries(spark, *lines):
    texts = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def event(name, time="2026-10-02T12:00:01.5+00:00", **context):
    return {"timestamp": time, "level": "INFO", "service": "s", "event": name,
            "message": name, **context}


def test_prefix_and_unreadable_lines(spark):
    lines = entries(spark, "api  | " + json.dumps(event("kafka_publish_succeeded", ticker="A")),
                    "Traceback", "{broken")
    rows = logs.parse_log_lines(lines).collect()
    assert [r.event for r in rows] == ["kafka_publish_succeeded", None, None]
    assert rows[0].ticker == "A" and rows[0].log_time.microsecond == 500000
    assert rows[1].line == "Traceback"


def test_topics_cover_known_events_only(spark):
    lines = entries(spark, event("kafka_publish_failed"), event("scheduler_started"),
                    event("delta_table_schema_compatible"), event("brapi_invalid_json"),
                    event("other"))
    topics = {r.event: r.log_topic for r in logs.by_topic(logs.parse_log_lines(lines)).collect()}
    assert topics == {"kafka_publish_failed": "publish", "scheduler_started": "scheduler",
                      "delta_table_schema_compatible": "layout_checks",
                      "brapi_invalid_json": "source_calls"}


def test_cycles_and_overruns(spark):
    lines = entries(
        spark, event("ticker_collection_succeeded", duracao_ms=100.25),
        event("ticker_collection_failed", "2026-10-02T12:00:09+00:00", duracao_ms=5),
        event("ticker_collection_unexpected_error", "2026-10-02T12:00:09+00:00"),
        event("scheduler_cycle_finished", "2026-10-02T12:04:59+00:00", duracao_ms=300001,
              sucessos=1, falhas=2),
        event("ticker_collection_succeeded", "2026-10-02T12:05:00+00:00", duracao_ms=1))
    parsed = logs.parse_log_lines(lines)
    first, second = logs.cycles(parsed).collect()
    assert (first.successes, first.failures, first.span_s, first.collecting_ms,
            first.overran) == (1, 2, 7, 105.25, True)
    assert (second.successes, second.failures, second.overran) == (1, 0, False)
    assert [(r.sucessos, r.falhas) for r in logs.overruns(parsed).collect()] == [(1, 2)]


def test_alerts_routes_and_secrets(spark):
    lines = entries(
        spark, {**event("x"), "level": "WARNING"}, {**event("y"), "level": "ERROR"}, event("z"),
        event("brapi_request_succeeded", endpoint_versao="v2"),
        event("brapi_request_failed", endpoint_versao="v2"), "GET ?token=abc")
    parsed = logs.parse_log_lines(lines)
    assert sorted(r.event for r in logs.alerts(parsed).collect()) == ["x", "y"]
    assert [tuple(r) for r in logs.route_counts(parsed).collect()] == [("v2", 1)]
    assert [r.value for r in logs.secret_lines(lines).collect()] == ["GET ?token=abc"]
