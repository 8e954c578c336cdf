"""Bronze, Silver, quarantine and Gold on small static frames."""

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from quotelake.operators.bronze import to_bronze
from quotelake.operators.gold import to_gold, to_gold_financial, to_gold_operational
from quotelake.operators.quarantine import row_accounting, to_quarantine
from quotelake.operators.silver import to_silver
from quotelake.schema import (
    BRONZE_COLUMNS, COLUMN_TYPES, GOLD_COLUMNS, QUARANTINE_COLUMNS, QUOTE_FIELDS,
    SILVER_COLUMNS, ddl,
)

UTC = timezone.utc
NOON = datetime(2025, 3, 9, 12, 0, tzinfo=UTC)
QUOTE = {
    "symbol": "KLM8", "shortName": "Klm", "currency": "XTS", "regularMarketPrice": 8.25,
    "regularMarketTime": "2025-03-09T07:30:15.000Z", "regularMarketChange": -2.0,
    "marketCap": 64.0, "regularMarketVolume": 12,
}
# Rule -> values of its field that break it.
BROKEN = {
    "invalid_symbol": ("symbol", [None, "", "   "]),
    "invalid_price": ("regularMarketPrice", [None, 0.0, -0.01, float("-inf")]),
    "invalid_quote_time": ("regularMarketTime", [None, "", "2025-13-01T00:00:00Z", "tomorrow"]),
    "invalid_ingest_time": ("ingest_time", [None]),
}
BARE_BRONZE = "kafka_time timestamp, ingest_time timestamp, " + ddl(QUOTE_FIELDS)


def bodies(spark, *texts):
    return spark.createDataFrame([(NOON, text) for text in texts],
                                 "timestamp timestamp, value string")


def bronze_rows(spark, *changes):
    rows = []
    for change in changes:
        row = {"kafka_time": NOON, "ingest_time": NOON, **dict.fromkeys(QUOTE_FIELDS),
               **QUOTE, **change}
        rows.append(tuple(row[f.split("`")[1]] if "`" in f else row[f.split()[0]]
                          for f in BARE_BRONZE.split(", ")))
    return spark.createDataFrame(rows, BARE_BRONZE)


def test_valid_and_truncated_message(spark):
    good = json.dumps({"results": [QUOTE], "took": 1})
    rows = to_bronze(bodies(spark, good, '{"results": [')).orderBy("parse_status").collect()
    broken, fine = rows
    assert (fine.symbol, fine.regularMarketPrice, fine.raw_json) == ("KLM8", 8.25, good)
    assert (broken.parse_status, broken.symbol, broken.raw_json) == (
        "parse_error", None, '{"results": [')
    assert fine.topic is None and fine.ingest_time is not None


def test_metadata_is_kept_and_columns_are_in_order(spark):
    message = [("quotes", 2, 7, b"KLM8", NOON, json.dumps({"results": [QUOTE]}).encode())]
    frame = spark.createDataFrame(
        message, "topic string, partition int, offset bigint, key binary, "
                 "timestamp timestamp, value binary")
    bronze = to_bronze(frame)
    assert tuple(bronze.columns) == BRONZE_COLUMNS
    assert {n: t for n, t in bronze.dtypes} == {n: COLUMN_TYPES[n] for n in BRONZE_COLUMNS}
    row = bronze.first()
    assert (row.topic, row.partition, row.offset, row.key) == ("quotes", 2, 7, "KLM8")


STATUSES = [
    (None, "parse_error", 1), ("", "parse_error", 1), ("null", "parse_error", 1),
    ("[1]", "parse_error", 1), ('{"results":"x"}', "parse_error", 1),
    ("{}", "no_result", 1), ('{"results":[]}', "no_result", 1),
    ('{"results":[null]}', "parse_ok", 1),
    ('{"results":[{"symbol":"A"},{"symbol":"B"}],"other":1}', "parse_ok", 2),
    ('{"results":[{"symbol":"A"}],"took":"x"}', "parse_error", 1),
    ('{"results":[{"symbol":"A","regularMarketVolume":3000000000}]}', "parse_ok", 1),
]


def test_parse_status(spark):
    rows = to_bronze(bodies(spark, *[body for body, _, _ in STATUSES])).collect()
    for body, status, count in STATUSES:
        assert [r.parse_status for r in rows if r.raw_json == body] == [status] * count, body


def test_silver_types(spark):
    silver = to_silver(bronze_rows(spark, {}))
    assert tuple(silver.columns) == SILVER_COLUMNS
    assert {n: t for n, t in silver.dtypes} == {n: COLUMN_TYPES[n] for n in SILVER_COLUMNS}
    row = silver.first()
    assert (row.trade_date, row.quote_time) == ("2025-03-09", datetime(2025, 3, 9, 7, 30, 15))
    assert (row.price, row.volume) == (8.25, 12) and row.silver_time is not None


def test_each_broken_rule_is_named_and_keeps_a_row_out(spark):
    changes = [(reason, {field: value}) for reason, (field, values) in BROKEN.items() for value in values]
    bronze = bronze_rows(spark, {}, *[change for _, change in changes])
    assert to_silver(bronze).count() == 1
    assert sorted(r.rejection_reason for r in to_quarantine(bronze).collect()) == sorted(
        reason for reason, _ in changes)


def test_dedup_key_and_survivor(spark):
    """Each part of the key tells quotes apart; the earliest copy survives."""
    copies = [{"kafka_time": NOON + timedelta(seconds=s)} for s in (90, 0, 5)]
    others = [{"symbol": "KLM9"}, {"regularMarketPrice": 8.26}, {"regularMarketTime": "2025-03-09T07:30:16Z"}]
    rows = to_silver(bronze_rows(spark, *copies, *others)).collect()
    assert len(rows) == 1 + len(others)
    assert {row.kafka_time for row in rows} == {NOON.replace(tzinfo=None)}


def test_nan_and_time_options(spark):
    nan = bronze_rows(spark, {"regularMarketPrice": float("nan")})
    assert to_silver(nan).count() == 1 and to_silver(nan, reject_nan=True).count() == 0
    assert to_quarantine(nan, reject_nan=True).first().rejection_reason == "invalid_price"
    day = bronze_rows(spark, {"regularMarketTime": "10:00"})
    assert to_silver(day).count() == 1 and to_silver(day, strict_time=True).count() == 0


def test_tab_is_no_blank_symbol(spark):
    assert to_silver(bronze_rows(spark, {"symbol": "\t"})).count() == 1


def test_quarantine_keeps_layout_text_and_all_reasons(spark):
    texts = ["not json", json.dumps({"results": [{**QUOTE, "symbol": " ", "regularMarketPrice": -4}]}),
             json.dumps({"results": []}), json.dumps({"results": [QUOTE]})]
    held = to_quarantine(to_bronze(bodies(spark, *texts)))
    assert tuple(held.columns) == QUARANTINE_COLUMNS
    nothing = "invalid_symbol,invalid_price,invalid_quote_time"
    assert {row.raw_json: row.rejection_reason for row in held.collect()} == {
        texts[0]: f"parse_error,{nothing}", texts[1]: "invalid_symbol,invalid_price",
        texts[2]: f"no_result,{nothing}"}


def test_parse_error_with_usable_quote_goes_both_ways(spark):
    bronze = to_bronze(bodies(spark, json.dumps({"results": [QUOTE], "took": "x"})))
    assert to_silver(bronze).count() == to_quarantine(bronze).count() == 1
    assert to_silver(bronze, strict_parse=True).count() == 0
    assert [r.destination for r in row_accounting(bronze).collect()] == ["both"]
    assert [r.destination for r in row_accounting(bronze, strict_parse=True).collect()] == [
        "quarantine"]


def ticks(spark, *rows):
    return spark.createDataFrame(
        [(NOON + timedelta(minutes=q), NOON + timedelta(minutes=i), s, p) for q, i, s, p in rows],
        "quote_time timestamp, ingest_time timestamp, symbol string, price double")


def test_each_gold_table_has_its_clock(spark):
    """Prices 1, 2, 4 of one symbol: quoted in one window, ingested in two."""
    silver = ticks(spark, (1, 2, "KLM8", 1.0), (2, 7, "KLM8", 2.0), (3, 9, "KLM8", 4.0), (3, 2, "XYZ", 9.0))

    def windows(gold, symbol="KLM8"):
        return sorted((r.window_start.minute, r.window_end.minute, r.avg_price, r.min_price, r.max_price,
                       r.samples, r.time_basis) for r in gold.collect() if r.symbol == symbol)

    assert windows(to_gold_operational(silver)) == [
        (0, 5, 1.0, 1.0, 1.0, 1, "ingest_time"), (5, 10, 3.0, 2.0, 4.0, 2, "ingest_time")]
    assert windows(to_gold_financial(silver)) == [(0, 5, 7 / 3, 1.0, 4.0, 3, "quote_time")]
    assert windows(to_gold(silver), "XYZ") == [(0, 5, 9.0, 9.0, 9.0, 1, "ingest_time")]
    assert tuple(to_gold(silver).columns) == GOLD_COLUMNS


def test_window_is_half_open(spark):
    rows = to_gold_financial(ticks(spark, (4.999, 0, "A", 1.0), (5, 0, "A", 2.0))).collect()
    assert sorted(r.window_start.minute for r in rows) == [0, 5]


def test_clock_is_injectable(spark):
    fixed = F.lit("2023-01-01 00:00:00").cast("timestamp")
    assert to_bronze(bodies(spark, "{}"), fixed).first().ingest_time == datetime(2023, 1, 1)
