"""What the physical plans must look like at any size."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from quotelake.operators import edge, logs, measures, series
from quotelake.operators.bronze import to_bronze
from quotelake.operators.gold import to_gold_financial
from quotelake.operators.silver import to_silver
from quotelake.plans import registry
from quotelake.plans.report import sections
from quotelake.sources import from_events as source
from quotelake.sources import lake


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return lake.open_lake(spark, registry.lake_root(spark, SMALL))


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "messages")
    source.quote_messages(source.read_events(spark, SMALL)).write.parquet(path)
    return spark.read.parquet(path)


def test_each_message_is_parsed_once(messages):
    bronze = to_bronze(messages)
    assert plan(bronze).count("from_json(") == 1
    assert plan(to_gold_financial(to_silver(bronze))).count("from_json(") == 1


def test_validity_rules_reach_the_scan_of_stored_bronze(tables):
    pushed = plan(to_silver(tables.bronze))
    for predicate in ("IsNotNull(symbol)", "GreaterThan(regularMarketPrice,0.0)",
                      "IsNotNull(ingest_time)"):
        assert predicate in pushed


def test_report_window_and_columns_reach_the_scan(tables):
    text = plan(sections(tables, registry.REPORT_WINDOW)["03 prices by symbol"]())
    assert "GreaterThanOrEqual(kafka_time,2024-01-08" in text
    assert "LessThan(kafka_time,2024-01-20" in text
    assert "ReadSchema: struct<kafka_time:timestamp,symbol:string,price:double>" in text


def test_windows_skip_the_folders_of_other_days(tables):
    from quotelake.plans.catalogue import catalogue

    jobs = {t: job for t, job in sections(tables, registry.REPORT_WINDOW).items() if t != "00 window"}
    jobs |= {n: j for n, j in catalogue(tables, registry.NOW).items() if n.endswith("_24h")}
    for title, job in jobs.items():
        text = plan(job())
        scans = re.findall(r"PartitionFilters: \[(.*?)\]", text)
        assert scans and all("_date" in scan for scan in scans), title


def test_no_query_deals_its_source_anew(spark):
    for name, query in registry.queries().items():
        assert "REPARTITION_BY_NUM" not in plan(query(spark, SMALL)) and "RoundRobin" not in plan(
            query(spark, SMALL)), name


def test_whole_percentiles_sort_strips_not_seconds(tables):
    text = plan(measures.latency_percentiles(tables.silver, ()))
    single = text[:text.rindex("SinglePartition")]
    assert "strip" in text and "Window" in single


def test_dedup_and_latest_prune_before_the_shuffle(tables):
    for frame in (to_silver(tables.bronze), series.latest_quotes(tables.silver)):
        text = plan(frame)
        assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*Partial",
                         text)


def test_gaps_shuffle_slots_not_messages(tables):
    text = plan(series.message_gaps(tables.bronze))
    assert text.index("Window [lag") < text.index("functions=[min(") < text.index("partial_min(")
    assert "TakeOrderedAndProject" in text


def test_percentiles_and_aggregates_use_hash_aggregation(tables):
    for frame in (measures.latency_percentiles(tables.silver), measures.source_lag(tables.silver),
                  measures.quality_scores(tables.silver, ["symbol"]),
                  to_gold_financial(tables.silver)):
        text = plan(frame)
        assert "HashAggregate" in text
        assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_coverage_broadcasts_only_the_narrowed_aggregate(tables):
    text = plan(series.coverage(tables.bronze, ["A", "B"], 1))
    assert "BroadcastHashJoin" in text and "PushedFilters: [In(symbol, [A,B])" in text


def test_no_cartesian_or_python_in_any_query(spark):
    for name, query in registry.queries().items():
        text = plan(query(spark, SMALL))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval",
                     "MapInPandas"):
            assert word not in text, name


def test_responses_and_log_lines_are_parsed_once(spark):
    events = source.read_events(spark, SMALL)
    gated = edge.gate(source.raw_responses(events))
    assert plan(edge.publishable(gated)).count("parseJson(") == 1
    assert plan(edge.refused(gated)).count("parseJson(") == 1
    entries = logs.parse_log_lines(source.log_lines(events).select("value"))
    for frame in (logs.by_topic(entries), logs.cycles(entries), logs.alerts(entries)):
        assert plan(frame).count("from_json(") == 1


def test_topic_filter_of_stored_partitions_prunes_folders(tables):
    one = tables.silver.filter((F.col("symbol") == "CLICK") & (F.col("trade_date") == "2024-01-05"))
    assert re.search(r"PartitionFilters: \[.*symbol.*trade_date.*\]", plan(one))


def test_rows_of_days_come_from_footers(spark):
    root = registry.lake_root(spark, SMALL)
    for spec in lake.TABLES:
        counts = lake.footer_counts(spark, root, spec)
        text = plan(counts)
        found = re.search(r"PushedAggregation: \[COUNT\(\*\)\].*ReadSchema: struct<(.*?)>", text)
        assert spec.snapshots or found and found[1] == f"{spec.partitions[0]}:string,count(*):bigint", text
        assert counts.agg({"rows": "sum"}).first()[0] == lake.read_table(spark, root, spec).count()


def test_parts_of_bronze_come_from_messages_made_once(spark):
    """Lakes that get Bronze in parts write no message twice, and parse only those of the part."""
    from datetime import datetime, timezone

    noon = F.lit(datetime(2024, 1, 16, tzinfo=timezone.utc))
    parts = [registry._bronze_part(spark, SMALL, keep) for keep in (lambda t: t >= noon, lambda t: t < noon)]
    for part in parts:
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "to_json" not in plan and "PushedFilters: [IsNotNull(timestamp)" in plan
    assert sum(part.count() for part in parts) == registry._bronze(spark, SMALL).count()


def test_audit_texts_are_held_against_the_messages_that_were_sent(spark):
    """The stream's own message files, which are not made a second time."""
    plan = registry._audit_texts(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "sha2" in plan
