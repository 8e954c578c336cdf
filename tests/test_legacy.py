"""Existing table names, log files and the command line."""

import json

import pytest
from conftest import SMALL

from quotelake.plans import registry
from quotelake.sources import lake, legacy
from quotelake.sources.kafka import publish_options
from quotelake.sources.log_files import read_log_lines, start_topic_tables, stream_log_lines
from quotelake.streaming.__main__ import arguments, start
from quotelake.streaming.sinks import ALL_AVAILABLE


def test_round_trip_of_each_table(spark):
    tables = lake.open_lake(spark, registry.lake_root(spark, SMALL))
    for spec, frame in zip(lake.TABLES, (tables.bronze, tables.silver, tables.quarantine,
                                         tables.gold_operational, tables.gold_financial)):
        frame = frame.select(*spec.columns)
        old = legacy.to_legacy(frame, spec)
        back = legacy.from_legacy(old, spec)
        assert back.schema.simpleString() == frame.schema.simpleString()
        assert back.exceptAll(frame).isEmpty() and frame.exceptAll(back).isEmpty()


def test_views_answer_existing_queries(spark):
    root = registry.lake_root(spark, SMALL)
    lake.register_tables(spark, root, prefix="old_")
    legacy.create_legacy_views(spark, "old_")
    reasons = {r[0] for r in spark.sql(
        "SELECT rejection_reason, count(*) FROM silver_cotacoes_rejeitadas GROUP BY 1").collect()}
    assert "ticket_invalido" in reasons
    row = spark.sql("""
        SELECT count(*) AS total, count_if(valor_atual <= 0) AS bad,
          count_if(ticket_ativo_b3 IS NULL) AS unnamed FROM silver_cotacoes""").first()
    assert row.total > 0 and row.bad == row.unnamed == 0
    assert {r[0] for r in spark.sql(
        "SELECT DISTINCT periodo_base FROM gold_media_precos_ingestao_5min").collect()} == {
            "data_hora_ingestao"}


def test_log_files_become_topic_tables(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    lines = [json.dumps({"timestamp": "2026-10-02T12:00:00Z", "level": "INFO", "event": name})
             for name in ("scheduler_started", "kafka_publish_succeeded", "other")]
    (folder / "a.log").write_text("\n".join(lines))
    assert read_log_lines(spark, str(folder)).count() == 3
    out = str(tmp_path / "out")
    start_topic_tables(stream_log_lines(spark, str(folder), 1), out, str(tmp_path / "cp"),
                       ALL_AVAILABLE).awaitTermination()
    assert sorted(r.log_topic for r in spark.read.parquet(out).collect()) == [
        "publish", "scheduler"]


def test_publish_waits_for_all_replicas():
    assert publish_options("host:9092", "quotes")["kafka.acks"] == "all"


def test_command_line(spark, root):
    where = ["--root", root, "--checkpoints", root]
    for refused in (["bronze"], ["edge", "--files", root], ["silver", "--max-files", "1"]):
        with pytest.raises(SystemExit):
            arguments([*refused, *where])
    message = json.dumps({"results": [{
        "symbol": "A", "regularMarketPrice": 1, "regularMarketTime": "2024-01-01T10:00:00Z"}]})
    spark.createDataFrame([(message,)], "value string").selectExpr(
        "'t' AS topic", "0 AS partition", "1L AS offset", "'A' AS key",
        "current_timestamp() AS timestamp", "value").write.parquet(f"{root}/in")
    for job in ("bronze", "silver", "quarantine", "gold_financial"):
        given = [job, "--root", root, "--checkpoints", f"{root}/cp", "--once"]
        for query in start(spark, arguments(given + (["--files", f"{root}/in"] if job == "bronze" else []))):
            query.awaitTermination()
    assert lake.read_table(spark, root, lake.GOLD_FINANCIAL).first().avg_price == 1.0
