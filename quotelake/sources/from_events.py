"""Quote messages, raw responses and log lines derived from the ``events`` table.

Each event becomes one input of the lake; the remainder of its id decides which defect,
if any, the input carries. Everything is a column expression, so the work grows with the
table. An event of some ten bytes becomes a document a hundred times as long, so events are
dealt out while they are small: the tasks follow the rows, not the bytes or row groups of
the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC = "quotes"
COPY_OFFSET = 1_000_000_000
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Events that one task turns into documents, of up to 2 KB each in memory.
EVENTS_PER_TASK = 100_000


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with a zoned timestamp, at most about ``EVENTS_PER_TASK`` rows a task."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    tasks = -(-events.count() // EVENTS_PER_TASK)
    events = events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    # Dealt by the whole row, so that neither a row group nor a repeated id makes a large task.
    return events.repartition(tasks, F.xxhash64(*events.columns)) if tasks > 1 else events


def plus_seconds(moment: str, seconds: str) -> str:
    """SQL text: a timestamp moved by whole seconds."""
    return f"timestamp_micros(unix_micros({moment}) + ({seconds}) * 1000000)"


def _case(cases: dict[int, str], of: str, otherwise: str) -> str:
    branches = " ".join(f"WHEN {remainder} THEN {sql}" for remainder, sql in cases.items())
    return f"CASE {of} {branches} ELSE {otherwise} END"


def _quote(symbol: str, price: str, time_text: str, volume: str) -> str:
    fields = {
        "symbol": symbol,
        "shortName": "symbol",
        "longName": "symbol || ' SA'",
        "currency": "'BRL'",
        "regularMarketPrice": price,
        "regularMarketDayHigh": "value + 1",
        "regularMarketDayLow": "value - 1",
        "regularMarketDayRange": "user_id || ' - ' || event_id",
        "regularMarketChange": "IF(event_id % 7 <> 0, value / 100, NULL)",
        "regularMarketChangePercent": "value / 10",
        "regularMarketTime": time_text,
        "marketCap": _case({0: "NULL", 3: "0D"}, "event_id % 10", "value * 1e6D"),
        "regularMarketVolume": volume,
        "regularMarketPreviousClose": "value - 0.5D",
        "regularMarketOpen": "value + 0.25D",
        "fiftyTwoWeekRange": "event_id || ' - ' || user_id",
        "fiftyTwoWeekLow": "value * 0.5D",
        "fiftyTwoWeekHigh": "value * 2",
        "priceEarnings": "value / 4",
        "earningsPerShare": "value / 8",
        "logourl": "'https://example.org/' || symbol || '.svg'",
    }
    return f"named_struct({', '.join(f'{name!r}, {sql}' for name, sql in fields.items())})"


def quote_messages(events: DataFrame) -> DataFrame:
    """Kafka-shaped rows, one per event; by ``event_id % 50``:

    0 truncated body, 1 empty results, 2 null symbol, 3 blank symbol, 4 null price,
    5 negative price, 6 unreadable time, 7 volume above 2^31, 8 sent twice,
    9 a second quote ``EXTRA`` in the message, 10 a ``took`` of the wrong type.
    """
    kind = "event_id % 50"
    main = _quote(
        _case({2: "NULL", 3: "'   '"}, kind, "symbol"),
        _case({4: "NULL", 5: "-value"}, kind, "value"),
        _case({6: "'not-a-time'"}, kind, "iso"),
        _case({7: "3000000000L"}, kind, "event_id"))
    extra = _quote("'EXTRA'", "value", "iso", "event_id")
    took = _case({10: "'\"x\"'"}, kind, "'1'")
    body = (
        f"concat('{{\"results\":', to_json(IF({kind} = 9, array({main}, {extra}), array({main}))),"
        f" ',\"requestedAt\":\"', iso, '\",\"took\":', {took}, '}}')")
    text = _case({0: "'{\"results\": ['", 1: "'{\"results\":[],\"took\":1}'"}, kind, body)
    return (
        events.selectExpr(
            "user_id", "event_id", "value", "upper(event_type) AS symbol", "ts",
            f"date_format(ts, {ISO_MICROS!r}) AS iso")
        .selectExpr(
            "user_id", "event_id", "symbol",
            f"{plus_seconds('ts', 'event_id * 37 % 900')} AS arrival", f"{text} AS value",
            f"explode(IF({kind} = 8, array(0, 1), array(0))) AS copy")
        .selectExpr(
            f"'{TOPIC}' AS topic", "CAST(user_id % 4 AS INT) AS partition",
            f"event_id + copy * {COPY_OFFSET}L AS offset", "symbol AS key",
            f"{plus_seconds('arrival', 'copy * 60')} AS timestamp", "value")
    )


def ingest_clock() -> Column:
    """Bronze stamp: up to 10 minutes after arrival; null for ``offset % 50 = 11``."""
    return F.expr(f"IF(offset % 50 <> 11, {plus_seconds('kafka_time', 'offset * 13 % 600')}, NULL)")


def silver_clock() -> Column:
    """Silver stamp: up to 5 minutes after ingestion."""
    return F.expr(plus_seconds("ingest_time", "offset * 7 % 300"))


def gold_clock() -> Column:
    """Gold stamp: ten minutes after the window closed."""
    return F.expr(plus_seconds("window_end", "600"))


def raw_responses(events: DataFrame) -> DataFrame:
    """(event_id, ticker, body) as a collector would receive them; by ``event_id % 20``:

    0 flat result, 1 nested result, 2 outer null beats nested, 3 no results,
    4 results is text, 5 price as text, 6 whole float volume, 7 broken float volume,
    8 number for a text field, 9 unknown field, 10 broken JSON, 11 result is text,
    12 flag as text, 13 flag as price, 14 took as text, 15 two results,
    16 array at the top, 17 no results key, 18 bad ticker, 19 padded lower-case ticker.
    """
    symbol = '"symbol":"%1$s"'
    price, volume = '"regularMarketPrice":%2$s', '"regularMarketVolume":%3$s'

    def one(result: str) -> str:
        return f'{{"results":[{{{result}}}],"requestedAt":"2024-01-01T00:00:00Z","took":1}}'

    templates = {
        1: one(f'{symbol},"data":{{"symbol":"INNER",{price},{volume}}}'),
        2: one(f'"symbol":null,"data":{{"symbol":"INNER",{price}}}'),
        3: '{"results":[],"took":1}',
        4: '{"results":"%1$s"}',
        5: one(f'{symbol},"regularMarketPrice":" %2$s "'),
        6: one(f"{symbol},{volume}.0"),
        7: one(f"{symbol},{volume}.5"),
        8: one('"symbol":%3$s'),
        9: one(f'{symbol},{price},"unknown":{{"a":[1,2]}}'),
        10: '{"results":[',
        11: '{"results":["x"]}',
        12: one(f'{symbol},"changed":"Yes"'),
        13: one(f'{symbol},"regularMarketPrice":true'),
        14: f'{{"results":[{{{symbol}}}],"took":"7"}}',
        15: f'{{"results":[{{{symbol},{price}}},{{"symbol":"EXTRA"}}]}}',
        16: "[1]",
        17: '{"took":1}',
    }

    def filled(template: str) -> str:
        return f"format_string('{template}', symbol, CAST(value AS STRING), CAST(event_id AS STRING))"

    kind = "event_id % 20"
    body = _case({k: filled(t) for k, t in templates.items()}, kind,
                 filled(one(f"{symbol},{price},{volume}")))
    ticker = _case({18: "symbol || '?token=x'", 19: "' ' || lower(symbol) || '\\t'"}, kind, "symbol")
    return events.selectExpr("event_id", "upper(event_type) AS symbol", "value").selectExpr(
        "event_id", f"{ticker} AS ticker", f"{body} AS body")


def log_lines(events: DataFrame) -> DataFrame:
    """(event_id, value) log lines, one per event.

    ``error`` events are errors, ``signup`` events warnings. Ids ending in 01 finish a
    scheduler cycle; of the others even ids are source calls (failed for every eighth),
    odd ids collections (failed for every seventh). Every 97th line carries a
    credential, every third a container prefix.
    """
    finished = "event_id % 100 = 1"
    entry = {
        "timestamp": f"date_format(ts, {ISO_MICROS!r})",
        "level": "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' "
                 "ELSE 'INFO' END",
        "service": "'collector'",
        "event": f"CASE WHEN {finished} THEN 'scheduler_cycle_finished' "
                 "WHEN event_id % 8 = 0 THEN 'brapi_request_failed' "
                 "WHEN event_id % 2 = 0 THEN 'brapi_request_succeeded' "
                 "WHEN event_id % 7 = 0 THEN 'ticker_collection_failed' "
                 "ELSE 'ticker_collection_succeeded' END",
        "message": "IF(event_id % 97 = 0, 'GET /quote?token=REDACTED', 'done')",
        "ticker": "upper(event_type)",
        "endpoint_versao": "IF(event_id % 5 = 0, 'v1_legado', 'v2')",
        "duracao_ms": f"IF({finished}, round(value * 10000, 0), value)",
        "sucessos": f"IF({finished}, event_id % 15, NULL)",
        "falhas": f"IF({finished}, 15 - event_id % 15, NULL)",
    }
    fields = ", ".join(f"{name!r}, {sql}" for name, sql in entry.items())
    return events.selectExpr(
        "event_id",
        f"IF(event_id % 3 = 0, 'api  | ', '') || to_json(named_struct({fields})) AS value")
