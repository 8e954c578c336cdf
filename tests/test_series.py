"""Gaps, latest quote, coverage and percentiles against brute force."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

from quotelake.operators import measures, series

UTC = timezone.utc
BASE = datetime(2024, 1, 1, tzinfo=UTC)


def bare(moment):
    return moment.replace(tzinfo=None)


def messages(spark, rows):
    return spark.createDataFrame(
        rows, "symbol string, kafka_time timestamp, parse_status string")


def brute_gaps(rows, threshold):
    times = defaultdict(list)
    for symbol, moment, _ in rows:
        if symbol is not None:
            times[symbol].append(moment)
    found = []
    for symbol, moments in times.items():
        moments.sort()
        for before, after in zip(moments, moments[1:]):
            seconds = math.floor((after - before) / timedelta(seconds=1))
            if seconds > threshold:
                found.append((-seconds, symbol, bare(after), bare(before)))
    return sorted(found)


def gap_rows(frame):
    return [(-r.gap_s, r.symbol, r.current_message, r.previous_message) for r in frame.collect()]


def test_gaps_with_a_dominant_symbol_and_ties(spark):
    random.seed(7)
    rows = []
    for symbol, count in (("HOT", 1500), ("A", 200), ("B", 40), (None, 50), ("ONE", 1)):
        moment = BASE - timedelta(days=20_000)
        for _ in range(count):
            step = random.choice([0, 0.000001, 1, 60, 419.999999, 420, 420.999999, 421, 900, 90_000])
            moment += timedelta(seconds=step)
            rows.append((symbol, moment, "parse_ok"))
    random.shuffle(rows)
    for threshold in (420, 60, 1, 0):
        frame = series.message_gaps(messages(spark, rows), threshold, limit=None)
        assert gap_rows(frame) == brute_gaps(rows, threshold), threshold
    top = series.message_gaps(messages(spark, rows), limit=3)
    assert gap_rows(top) == brute_gaps(rows, 420)[:3]


def test_coverage_counts_and_absent_tickers(spark):
    rows = [("A", BASE, "parse_ok"), ("A", BASE + timedelta(minutes=1), "parse_error"),
            ("A", BASE + timedelta(minutes=2), "parse_ok"), ("OTHER", BASE, "parse_ok")]
    found = series.coverage(messages(spark, rows), ["B", "A", "A"], 1).collect()
    assert [tuple(r) for r in found] == [
        ("A", 3, 2, 1, 200.0, bare(BASE), bare(BASE + timedelta(minutes=2))),
        ("B", 0, 0, 1, 0.0, None, None)]


def silver(spark, rows):
    return spark.createDataFrame(
        rows, "symbol string, price double, quote_time timestamp, kafka_time timestamp, "
              "ingest_time timestamp, silver_time timestamp, market_cap double, change double")


def ticks(latencies, symbol="A"):
    return [(symbol, 1.0, BASE, BASE, BASE, BASE + timedelta(seconds=s), 1.0, None)
            for s in latencies]


def test_percentiles_are_exact(spark):
    random.seed(3)
    for size in (1, 2, 7, 100, 999):
        values = [random.randint(-50, 1500) for _ in range(size)]
        row = measures.latency_percentiles(silver(spark, ticks(values))).first()
        ranked = sorted(values)
        expected = [ranked[-(-size * rank // 100) - 1] for rank in (50, 95, 99)]
        assert [row.p50, row.p95, row.p99] == expected and row.samples == size


def test_scores_of_an_empty_table_are_null(spark):
    row = measures.quality_scores(silver(spark, [])).first()
    assert row["rows"] == 0 and row.overall_pct is None and row.validity_pct is None


def test_freshness_bounds(spark):
    frame = silver(spark, ticks([-1, 0, 660, 661]))
    assert measures.quality_scores(frame).first().freshness_pct == 50.0


def test_latest_quote_breaks_ties(spark):
    rows = [("A", 1.0, BASE, BASE, BASE, BASE, None, None),
            ("A", 2.0, BASE, BASE, BASE, BASE, None, None),
            ("A", 9.0, BASE - timedelta(1), BASE, BASE, BASE + timedelta(1), None, None)]
    row = series.latest_quotes(silver(spark, rows)).first()
    assert (row.price, row.last_update) == (2.0, "21:00:00")


def test_elapsed_time_counts_complete_units(spark):
    rows = [("A", 1.0, BASE + timedelta(seconds=0.9), BASE + timedelta(seconds=2.1),
             BASE + timedelta(seconds=2.1), BASE + timedelta(seconds=0.2), None, None)]
    row = measures.recent_latency(silver(spark, rows)).first()
    assert (row.source_to_kafka_s, row.kafka_to_silver_s) == (1, -1)
