"""The registered queries once more, as DuckDB SQL over the ``events`` table."""

from __future__ import annotations

NOW = "2024-01-30 12:00:00"
# 8 January 09:45 to 20 January 18:00 local time, three hours behind UTC.
START, END = "2024-01-08 12:45:00", "2024-01-20 21:00:00"
CYCLES = 3555
HALF = "2024-01-16 00:00:00"
TICKERS = ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW", "MISSING1")
KEPT_PANELS = ("overall_score", "validity", "completeness", "freshness", "latency", "messages_per_minute",
               "latest_quotes", "latency_series")
KEPT_METRICS = ("silver_quality", "stage_latency", "latency_percentiles", "silver_throughput")
# Report query -> title of its section.
SECTIONS = {
    "report_01_overview": "01 overview", "report_02_throughput": "02 throughput",
    "report_03_prices": "03 prices by symbol", "report_04a_bronze_quality": "04a bronze quality",
    "report_04b_silver_quality": "04b silver quality", "report_04c_rejects": "04c rejected rows",
    "report_04d_repeats": "04d repeated quotes", "report_05_span": "05 observed span",
    "report_06_stage_latency": "06 stage latency", "report_07_recent": "07 recent samples",
    "report_08_partitions": "08 partitions", "report_09_gold_operational": "09 gold operational",
    "report_10_gold_financial": "10 gold financial", "report_11_percentiles": "11 latency percentiles",
    "report_12_source_lag": "12 source lag", "report_13_scores": "13 quality scores",
    "report_14_coverage": "14 coverage", "report_15_gaps": "15 gaps",
}


def _after(moment: str, seconds: str) -> str:
    return f"{moment} + to_microseconds(CAST(({seconds}) * 1000000 AS BIGINT))"


def _seconds(start: str, end: str, unit: int = 1) -> str:
    return (f"CAST(trunc((epoch_us({end}) - epoch_us({start})) / {1000000 * unit}.0) AS BIGINT)")


def _round(value: str, digits: int = 2) -> str:
    """Half-up on the decimal value, as Spark rounds a double."""
    return f"CAST(round(CAST({value} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return _round(f"({part}) * 100.0::DOUBLE / nullif({whole}, 0)")


# Bronze field -> SQL over a message row (value, event_id, user_id, sym, kind, q).
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
_FIELDS = {
    "symbol": "CASE WHEN q = 1 THEN 'EXTRA' WHEN kind = 2 THEN NULL WHEN kind = 3 THEN '   ' "
              "ELSE sym END",
    "shortName": "sym",
    "longName": "sym || ' SA'",
    "currency": "'BRL'",
    "regularMarketPrice": "CASE WHEN q = 1 THEN value WHEN kind = 4 THEN NULL "
                          "WHEN kind = 5 THEN -value ELSE value END",
    "regularMarketDayHigh": "value + 1",
    "regularMarketDayLow": "value - 1",
    "regularMarketDayRange": "user_id || ' - ' || event_id",
    "regularMarketChange": "CASE WHEN event_id % 7 <> 0 THEN value / 100 END",
    "regularMarketChangePercent": "value / 10",
    "regularMarketTime": f"CASE WHEN kind = 6 AND q = 0 THEN 'not-a-time' ELSE {_ISO} END",
    "marketCap": "CASE WHEN event_id % 10 = 3 THEN 0.0 WHEN event_id % 10 <> 0 "
                 "THEN value * 1e6 END",
    "regularMarketVolume": "CASE WHEN kind = 7 THEN 3000000000 ELSE event_id END",
    "regularMarketPreviousClose": "value - 0.5::DOUBLE",
    "regularMarketOpen": "value + 0.25::DOUBLE",
    "fiftyTwoWeekRange": "event_id || ' - ' || user_id",
    "fiftyTwoWeekLow": "value * 0.5::DOUBLE",
    "fiftyTwoWeekHigh": "value * 2",
    "priceEarnings": "value / 4",
    "earningsPerShare": "value / 8",
    "logourl": "'https://example.org/' || sym || '.svg'",
}
_TYPES = {"symbol": "VARCHAR", "regularMarketTime": "VARCHAR", "regularMarketVolume": "BIGINT",
          "shortName": "VARCHAR", "longName": "VARCHAR", "currency": "VARCHAR",
          "regularMarketDayRange": "VARCHAR", "fiftyTwoWeekRange": "VARCHAR",
          "logourl": "VARCHAR"}
_BRONZE_FIELDS = ",\n    ".join(
    f"CAST(CASE WHEN kind NOT IN (0, 1) THEN {sql} END AS {_TYPES.get(name, 'DOUBLE')}) "
    f'AS "{name}"' for name, sql in _FIELDS.items())

_CTES = {
    "msgs": f"""
  SELECT event_id, user_id, value, ts, upper(event_type) AS sym, event_id % 50 AS kind,
    CAST(user_id % 4 AS INTEGER) AS "partition", event_id + copy * 1000000000 AS "offset",
    {_after("ts", "(event_id * 37) % 900 + copy * 60")} AS kafka_time
  FROM events CROSS JOIN (VALUES (0), (1)) AS copies(copy)
  WHERE copy = 0 OR event_id % 50 = 8""",
    "bronze": f"""
  SELECT 'quotes' AS topic, "partition", "offset", sym AS key, kafka_time,
    CASE WHEN kind IN (0, 10) THEN 'parse_error' WHEN kind = 1 THEN 'no_result'
      ELSE 'parse_ok' END AS parse_status,
    CASE WHEN "offset" % 50 <> 11 THEN {_after("kafka_time", '("offset" * 13) % 600')} END
      AS ingest_time,
    {_BRONZE_FIELDS},
    CASE WHEN kind NOT IN (0, 1) AND NOT (kind = 6 AND q = 0) THEN ts END AS quote_time
  FROM msgs CROSS JOIN (VALUES (0), (1)) AS quotes(q)
  WHERE q = 0 OR kind = 9""",
    "judged": """
  SELECT *, coalesce(trim(symbol), '') <> '' AND coalesce("regularMarketPrice" > 0, false)
      AND quote_time IS NOT NULL AND ingest_time IS NOT NULL AS accepted,
    concat_ws(',',
      CASE WHEN parse_status = 'parse_error' THEN 'parse_error' END,
      CASE WHEN parse_status = 'no_result' THEN 'no_result' END,
      CASE WHEN coalesce(trim(symbol), '') = '' THEN 'invalid_symbol' END,
      CASE WHEN NOT coalesce("regularMarketPrice" > 0, false) THEN 'invalid_price' END,
      CASE WHEN quote_time IS NULL THEN 'invalid_quote_time' END,
      CASE WHEN ingest_time IS NULL THEN 'invalid_ingest_time' END) AS rejection_reason
  FROM bronze""",
    "silver": f"""
  SELECT kafka_time, symbol, "shortName" AS short_name, "longName" AS long_name, currency,
    "regularMarketPrice" AS price, "regularMarketDayHigh" AS day_high,
    "regularMarketDayLow" AS day_low, "regularMarketDayRange" AS day_range,
    "regularMarketChange" AS change, "regularMarketChangePercent" AS change_pct, quote_time,
    "marketCap" AS market_cap, "regularMarketVolume" AS volume,
    "regularMarketPreviousClose" AS prev_close, "regularMarketOpen" AS open_price,
    "fiftyTwoWeekRange" AS range_52w, "fiftyTwoWeekLow" AS low_52w,
    "fiftyTwoWeekHigh" AS high_52w, "priceEarnings" AS pe_ratio, "earningsPerShare" AS eps,
    logourl AS logo_url, strftime(quote_time, '%Y-%m-%d') AS trade_date, ingest_time,
    {_after("ingest_time", '("offset" * 7) % 300')} AS silver_time
  FROM (SELECT *, row_number() OVER (
          PARTITION BY symbol, quote_time, "regularMarketPrice"
          ORDER BY kafka_time, "offset", "partition") AS place
        FROM judged WHERE accepted)
  WHERE place = 1""",
    "quarantine": """
  SELECT topic, "partition", "offset", key, kafka_time, parse_status, symbol,
    "regularMarketPrice", "regularMarketTime", "regularMarketChange", "marketCap",
    quote_time, ingest_time, rejection_reason
  FROM judged WHERE rejection_reason <> ''""",
}
for _name, _clock in (("gold_operational", "ingest_time"), ("gold_financial", "quote_time")):
    _CTES[_name] = f"""
  SELECT time_bucket(INTERVAL '5 minutes', {_clock}) AS window_start,
    time_bucket(INTERVAL '5 minutes', {_clock}) + INTERVAL '5 minutes' AS window_end, symbol,
    {_round("avg(price)", 6)} AS avg_price, min(price) AS min_price, max(price) AS max_price,
    count(price) AS samples, '{_clock}' AS time_basis,
    time_bucket(INTERVAL '5 minutes', {_clock}) + INTERVAL '15 minutes' AS gold_time
  FROM silver GROUP BY ALL"""

_NEEDS = {
    "msgs": (), "bronze": ("msgs",), "judged": ("bronze",), "silver": ("judged",),
    "quarantine": ("judged",), "gold_operational": ("silver",), "gold_financial": ("silver",),
}


def _with(tables: str, body: str, extra: str = "") -> str:
    """``body`` behind the CTEs it needs; ``extra`` adds CTEs of its own."""
    order: list[str] = []

    def need(table: str) -> None:
        for upstream in _NEEDS[table]:
            need(upstream)
        if table not in order:
            order.append(table)

    for table in tables.split():
        need(table)
    ctes = [f"{name} AS ({_CTES[name]})" for name in order] + ([extra] if extra else [])
    return f"WITH {', '.join(ctes)}\n{body}"


_STAGES = {
    "source_to_kafka": ("quote_time", "kafka_time"),
    "kafka_to_bronze": ("kafka_time", "ingest_time"),
    "bronze_to_silver": ("ingest_time", "silver_time"),
    "kafka_to_silver": ("kafka_time", "silver_time"),
    "source_to_silver": ("quote_time", "silver_time"),
}
_K2S = _seconds(*_STAGES["kafka_to_silver"])
_IN_WINDOW = f"kafka_time >= TIMESTAMP '{START}' AND kafka_time < TIMESTAMP '{END}'"
_GOLD_IN_WINDOW = _IN_WINDOW.replace("kafka_time", "window_start")
_LAST_DAY = f"kafka_time >= TIMESTAMP '{NOW}' - INTERVAL '1 day'"
_GOLD_COLUMNS = ("window_start, window_end, symbol, avg_price, min_price, max_price, samples, "
                 "time_basis, gold_time")


def _silver(select: str, rest: str = "", where: str = _IN_WINDOW) -> str:
    return _with("silver", f"SELECT {select} FROM silver WHERE {where} {rest}")


def _bronze_quality(where: str) -> str:
    return _with("bronze", f"""
SELECT count(*) AS rows, count(*) FILTER (coalesce(trim(symbol), '') <> '') AS with_symbol,
  count(*) FILTER ("regularMarketPrice" > 0) AS with_valid_price,
  count(*) FILTER (quote_time IS NOT NULL) AS with_valid_quote_time,
  count(*) FILTER (ingest_time IS NOT NULL) AS with_ingest_time
FROM bronze WHERE {where}""")


def _residue(clock: str, where: str) -> str:
    return _silver(f"""count(*) AS rows,
  count(*) FILTER (coalesce(trim(symbol), '') = '') AS invalid_symbols,
  count(*) FILTER (price IS NULL OR price <= 0) AS invalid_prices,
  count(*) FILTER (quote_time IS NULL) AS invalid_quote_times,
  count(*) FILTER ({clock} IS NULL) AS invalid_stamps""", where=where)


def _rejects(where: str) -> str:
    return _with("quarantine", f"SELECT rejection_reason, count(*) AS rows FROM quarantine "
                               f"WHERE {where} GROUP BY 1")


def _repeats(where: str) -> str:
    return _with("bronze", f"""
SELECT symbol, "regularMarketTime" AS quote_time_raw, "regularMarketPrice" AS price,
  count(*) AS occurrences
FROM bronze WHERE symbol IS NOT NULL AND "regularMarketTime" IS NOT NULL
  AND "regularMarketPrice" IS NOT NULL AND {where}
GROUP BY 1, 2, 3 HAVING count(*) > 1""")


def _stage_means(where: str, extremes: str = "") -> str:
    means = ", ".join(f"{_round(f'avg({_seconds(*ends)})')} AS avg_{stage}_s"
                      for stage, ends in _STAGES.items())
    return _silver(f"symbol, count(*) AS samples, {means}{extremes}", "GROUP BY symbol", where)


def _recent(order: str, where: str) -> str:
    parts = ", ".join(f"{_seconds(*ends)} AS {stage}_s" for stage, ends in _STAGES.items())
    return _silver(
        f"symbol, price, quote_time, kafka_time, ingest_time, silver_time, {parts}",
        f"ORDER BY {order} DESC, symbol, quote_time, price LIMIT 20", where)


def _percentiles(keys: str, where: str, samples: str = "") -> str:
    picks = ", ".join(f"quantile_disc({_K2S}, {rank}) AS {name}"
                      for name, rank in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))
    return _silver(f"{keys}{picks}{samples}", f"GROUP BY {keys.strip(', ')}" if keys else "", where)


_VALID = "count(*) FILTER (symbol IS NOT NULL AND price > 0)"
_COMPLETE = "count(*) FILTER (market_cap > 0)"
_FRESH = f"count(*) FILTER ({_K2S} BETWEEN 0 AND 660)"
_OVERALL = _round(
    f"(1.0::DOUBLE * {_VALID} / count(*) + 1.0::DOUBLE * {_COMPLETE} / count(*) "
    f"+ 1.0::DOUBLE * {_FRESH} / count(*)) / 3.0 * 100")


def _panel(score: str, value: str, yellow: int, green: int) -> str:
    return _with("silver", f"""
SELECT TIMESTAMP '{NOW}' AS time, {score}, CASE WHEN {score} >= {green} THEN 'green'
  WHEN {score} >= {yellow} THEN 'yellow' ELSE 'red' END AS band
FROM (SELECT {value} AS {score} FROM silver)""")


def _coverage(where: str, cycles: int, columns: str) -> str:
    values = ", ".join(f"('{ticker}')" for ticker in TICKERS)
    return _with("bronze", f"SELECT {columns} FROM covered", extra=f"""
received AS (
  SELECT symbol, count(*) AS n, count(*) FILTER (parse_status = 'parse_ok') AS ok,
    min(kafka_time) AS first_message, max(kafka_time) AS last_message
  FROM bronze WHERE {where} GROUP BY symbol),
covered AS (
  SELECT wanted.symbol, coalesce(n, 0) AS bronze_rows, coalesce(ok, 0) AS parse_ok_rows,
    {cycles}::BIGINT AS expected_cycles, {_pct("coalesce(ok, 0)", str(cycles))} AS coverage_pct,
    first_message, last_message
  FROM (VALUES {values}) AS wanted(symbol) LEFT JOIN received USING (symbol))""")


def _gaps(where: str, limit: str = "LIMIT 200") -> str:
    return _with("bronze", f"""
SELECT symbol, previous_message, current_message, gap_s FROM gaps
WHERE gap_s > 420 ORDER BY gap_s DESC, symbol, current_message {limit}""", extra=f"""
ordered AS (
  SELECT symbol, kafka_time AS current_message,
    lag(kafka_time) OVER (PARTITION BY symbol ORDER BY kafka_time) AS previous_message
  FROM bronze WHERE symbol IS NOT NULL AND {where}),
gaps AS (
  SELECT *, {_seconds("previous_message", "current_message")} AS gap_s FROM ordered)""")


def _bronze_columns(prefix: str = "") -> str:
    meta = ("topic", "partition", "offset", "key", "kafka_time", "parse_status", "ingest_time")
    return ", ".join(f'{prefix}"{name}"' for name in (*meta, *_FIELDS))


_LOGS = """
  SELECT *, event_id % 100 = 1 AS finished, upper(event_type) AS ticker,
    CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'WARNING'
      ELSE 'INFO' END AS level,
    CASE WHEN event_id % 100 = 1 THEN 'scheduler_cycle_finished'
      WHEN event_id % 8 = 0 THEN 'brapi_request_failed'
      WHEN event_id % 2 = 0 THEN 'brapi_request_succeeded'
      WHEN event_id % 7 = 0 THEN 'ticker_collection_failed'
      ELSE 'ticker_collection_succeeded' END AS event,
    CASE WHEN event_id % 100 = 1 THEN CAST(round(CAST(value * 10000 AS DECIMAL(38,6)), 0) AS DOUBLE)
      ELSE value END AS duracao_ms,
    CASE WHEN event_id % 5 = 0 THEN 'v1_legado' ELSE 'v2' END AS route
  FROM events"""

_EDGE = """
  SELECT event_id, event_id % 20 AS kind, upper(event_type) AS sym, value, event_id AS n,
    upper(event_type) || CASE WHEN event_id % 20 = 18 THEN '?TOKEN=X' ELSE '' END AS key
  FROM events"""
_EDGE_STATUS = """CASE WHEN kind = 10 THEN 'invalid_json' WHEN kind = 3 THEN 'no_quotes'
    WHEN kind IN (4, 7, 8, 11, 16, 17) THEN 'schema' ELSE 'ok' END"""


def oracle_sql() -> dict[str, str]:
    """Query name -> SQL."""
    last_three = ", ".join(f"{column}" for column in ("first_message", "last_message"))
    cover = "symbol, bronze_rows, parse_ok_rows, expected_cycles, coverage_pct, " + last_three
    typed = _CTES["silver"].split("FROM (SELECT")[0]
    strict = _CTES["silver"].replace("WHERE accepted", "WHERE rejection_reason = ''")
    everything = "true"
    sql = {
        "bronze_parse": _with("bronze", f"SELECT {_bronze_columns()} FROM bronze"),
        "bronze_status_counts": _with(
            "bronze", "SELECT parse_status, count(*) AS rows FROM bronze GROUP BY 1"),
        "bronze_explode": _with("bronze", """
SELECT "offset", count(*) AS rows, count("shortName") AS quotes FROM bronze GROUP BY 1"""),
        "bronze_bare_messages": _with("bronze", """
SELECT CAST(NULL AS VARCHAR) AS topic, CAST(NULL AS INTEGER) AS "partition",
  CAST(NULL AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS key, kafka_time, parse_status,
  kafka_time AS ingest_time, symbol, "regularMarketPrice" FROM bronze"""),
        "silver_typed": _with("bronze", typed + "FROM bronze"),
        "silver_clean": _with("silver", "SELECT * FROM silver"),
        "silver_strict": _with("judged", "SELECT * FROM strict", extra=f"strict AS ({strict})"),
        "silver_dedup": _with("judged", """
SELECT symbol, quote_time, "regularMarketPrice" AS price, min(kafka_time) AS kafka_time
FROM judged WHERE accepted GROUP BY 1, 2, 3"""),
        "silver_partitions": _silver(
            "symbol, trade_date, count(*) AS rows", "GROUP BY 1, 2", everything),
        "quarantine_rows": _with("quarantine", "SELECT * FROM quarantine"),
        "quarantine_reasons": _rejects(everything),
        "quarantine_reason_codes": _with("quarantine", """
SELECT reason, count(*) AS rows
FROM (SELECT unnest(string_split(rejection_reason, ',')) AS reason FROM quarantine)
GROUP BY 1"""),
        "row_accounting": _with("judged", """
SELECT CASE WHEN accepted AND rejection_reason <> '' THEN 'both' WHEN accepted THEN 'silver'
    ELSE 'quarantine' END AS destination, parse_status, count(*) AS rows
FROM judged GROUP BY 1, 2"""),
        "gold_operational": _with("gold_operational", "SELECT * FROM gold_operational"),
        "gold_financial": _with("gold_financial", "SELECT * FROM gold_financial"),
        "stream_bronze": _with("bronze", f"SELECT {_bronze_columns()} FROM bronze"),
        "stream_silver": _silver(
            "* EXCLUDE (kafka_time, ingest_time, silver_time)", where=everything),
        "stream_quarantine": _with("quarantine", "SELECT * FROM quarantine"),
        "report_00_window": _with("msgs", f"""
SELECT DISTINCT date_trunc('day', kafka_time - INTERVAL '3 hours')
    + INTERVAL '12 hours 45 minutes' AS start_utc,
  date_trunc('day', kafka_time - INTERVAL '3 hours') + INTERVAL '21 hours' AS end_utc,
  'America/Sao_Paulo' AS local_zone, 5::INTEGER AS poll_minutes, 99::BIGINT AS expected_cycles,
  {len(TICKERS)}::INTEGER AS tickers FROM msgs"""),
        "report_01_overview": _with(
            "bronze silver quarantine gold_operational gold_financial", f"""
SELECT 'Bronze' AS layer, count(*) AS rows FROM bronze WHERE {_IN_WINDOW}
UNION ALL SELECT 'Silver', count(*) FROM silver WHERE {_IN_WINDOW}
UNION ALL SELECT 'Silver rejected', count(*) FROM quarantine WHERE {_IN_WINDOW}
UNION ALL SELECT 'Gold operational', count(*) FROM gold_operational WHERE {_GOLD_IN_WINDOW}
UNION ALL SELECT 'Gold financial', count(*) FROM gold_financial WHERE {_GOLD_IN_WINDOW}"""),
        "report_02_throughput": _silver(
            f"date_trunc('minute', ingest_time) AS minute, count(*) AS rows, "
            f"{_round('count(*) / 60.0::DOUBLE')} AS rows_per_second", "GROUP BY 1"),
        "report_03_prices": _silver(f"""symbol, count(*) AS samples,
  {_round("avg(price)")} AS avg_price, min(price) AS min_price, max(price) AS max_price,
  {_round("max(price) - min(price)")} AS price_spread""", "GROUP BY symbol"),
        "report_04a_bronze_quality": _bronze_quality(_IN_WINDOW),
        "report_04b_silver_quality": _residue("ingest_time", _IN_WINDOW),
        "report_04c_rejects": _rejects(_IN_WINDOW),
        "report_04d_repeats": _repeats(_IN_WINDOW),
        "report_05_span": _silver(f"""min(ingest_time) AS first_ingest,
  max(ingest_time) AS last_ingest,
  {_seconds("min(ingest_time)", "max(ingest_time)")} AS span_seconds,
  {_seconds("min(ingest_time)", "max(ingest_time)", 60)} AS span_minutes"""),
        "report_06_stage_latency": _stage_means(
            _IN_WINDOW, f", min({_K2S}) AS min_kafka_to_silver_s, "
                        f"max({_K2S}) AS max_kafka_to_silver_s"),
        "report_07_recent": _recent("ingest_time", _IN_WINDOW),
        "report_08_partitions": _silver("symbol, trade_date, count(*) AS rows", "GROUP BY 1, 2"),
        "report_09_gold_operational": _with("gold_operational", f"""
SELECT {_GOLD_COLUMNS}, {_seconds("window_end", "gold_time")} AS recompute_age_s
FROM gold_operational WHERE {_GOLD_IN_WINDOW}"""),
        "report_10_gold_financial": _with(
            "gold_financial",
            f"SELECT {_GOLD_COLUMNS} FROM gold_financial WHERE {_GOLD_IN_WINDOW}"),
        "report_11_percentiles": _percentiles("symbol, ", _IN_WINDOW, ", count(*) AS samples"),
        "report_12_source_lag": _silver(f"""symbol,
  count(*) FILTER ({_seconds("quote_time", "kafka_time")} > 300) AS late_samples,
  {_pct(f"count(*) FILTER ({_seconds('quote_time', 'kafka_time')} > 300)", "count(*)")}
    AS late_pct,
  quantile_disc({_seconds("quote_time", "kafka_time")}, 0.95) AS p95_lag_s""",
                                        "GROUP BY symbol"),
        "report_13_scores": _silver(f"""symbol, count(*) AS rows,
  {_pct(_VALID, "count(*)")} AS validity_pct, {_pct(_COMPLETE, "count(*)")} AS completeness_pct,
  {_pct(_FRESH, "count(*)")} AS freshness_pct, {_pct("count(change)", "count(*)")} AS change_pct,
  {_OVERALL} AS overall_pct""", "GROUP BY symbol"),
        "report_14_coverage": _coverage(_IN_WINDOW, CYCLES, cover),
        "report_15_gaps": _gaps(_IN_WINDOW),
        "catalogue_bronze_quality": _bronze_quality(everything),
        "catalogue_silver_quality": _residue("silver_time", everything),
        "catalogue_silver_rejects": _rejects(everything),
        "catalogue_bronze_repeats": _repeats(everything),
        "catalogue_stage_latency": _stage_means(everything),
        "catalogue_latency_percentiles": _percentiles("symbol, ", everything),
        "catalogue_recent_latency": _recent("silver_time", everything),
        "catalogue_gold_recompute": _with("gold_operational", f"""
SELECT symbol, window_end, time_basis, gold_time,
  {_seconds("window_end", "gold_time")} AS recompute_age_s
FROM gold_operational ORDER BY window_end DESC, symbol LIMIT 10"""),
        "catalogue_gold_financial": _with("gold_financial", """
SELECT window_start, window_end, symbol, avg_price, min_price, max_price, samples, time_basis
FROM gold_financial ORDER BY window_start DESC, symbol LIMIT 10"""),
        "catalogue_silver_throughput": _silver(
            f"date_trunc('minute', silver_time) AS minute, count(*) AS rows, "
            f"{_round('count(*) / 60.0::DOUBLE')} AS rows_per_second",
            "GROUP BY 1 ORDER BY 1 DESC LIMIT 5", everything),
        "catalogue_coverage_24h": _coverage(
            _LAST_DAY, 288, "symbol, parse_ok_rows, expected_cycles, coverage_pct"),
        "catalogue_gaps_24h": _gaps(_LAST_DAY),
        "gaps_all": _gaps("true", ""),
        "dashboard_overall_score": _panel("overall_pct", _OVERALL, 80, 95),
        "dashboard_validity": _panel("validity_pct", _pct(_VALID, "count(*)"), 98, 98),
        "dashboard_completeness": _panel(
            "completeness_pct", _pct(_COMPLETE, "count(*)"), 90, 90),
        "dashboard_freshness": _panel("freshness_pct", _pct(_FRESH, "count(*)"), 85, 85),
        "dashboard_scores": _with("silver", f"""
SELECT *, {", ".join(
            f"CASE WHEN {score}_pct >= {green} THEN 'green' WHEN {score}_pct >= {yellow} "
            f"THEN 'yellow' ELSE 'red' END AS {score}_band"
            for score, yellow, green in (("overall", 80, 95), ("validity", 98, 98),
                                         ("completeness", 90, 90), ("freshness", 85, 85)))}
FROM (SELECT TIMESTAMP '{NOW}' AS time, {_OVERALL} AS overall_pct,
    {_pct(_VALID, "count(*)")} AS validity_pct, {_pct(_COMPLETE, "count(*)")} AS completeness_pct,
    {_pct(_FRESH, "count(*)")} AS freshness_pct FROM silver)"""),
        "dashboard_latency": _with("silver", f"""
SELECT p50, p95, p99, {", ".join(
            f"CASE WHEN {p} >= 900 THEN 'red' WHEN {p} >= 660 THEN 'yellow' ELSE 'green' END "
            f"AS {p}_band" for p in ("p50", "p95", "p99"))}
FROM (SELECT {", ".join(f"quantile_disc({_K2S}, {rank}) AS {name}" for name, rank in
                        (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))} FROM silver)"""),
        "dashboard_messages_per_minute": _silver(
            "date_trunc('minute', silver_time) AS minute, symbol, count(*) AS rows",
            "GROUP BY 1, 2", everything),
        "dashboard_latest_quotes": _with("silver", """
SELECT symbol, price, strftime(quote_time - INTERVAL '3 hours', '%H:%M:%S') AS last_update
FROM (SELECT *, row_number() OVER (
        PARTITION BY symbol ORDER BY quote_time DESC, silver_time DESC, price DESC) AS place
      FROM silver) WHERE place = 1"""),
        "dashboard_latency_series": _silver(
            f"date_trunc('minute', ingest_time) AS minute, symbol, "
            f"avg({_seconds('quote_time', 'ingest_time')}) AS avg_latency_s",
            "GROUP BY 1, 2", everything),
        "edge_ticker": f"""WITH edge AS ({_EDGE})
SELECT event_id, key, regexp_full_match(key, '\\^?[A-Z0-9]{{3,12}}') AS ticker_valid FROM edge""",
        "edge_normalise": f"""WITH edge AS ({_EDGE})
SELECT event_id, kind <> 11 AS is_object,
  CASE WHEN second = 1 THEN 'EXTRA' WHEN kind IN (2, 11) THEN NULL
    WHEN kind = 8 THEN CAST(n AS VARCHAR) ELSE sym END AS symbol,
  CASE WHEN second = 1 OR kind IN (6, 7, 8, 11, 12, 14) THEN NULL WHEN kind = 13 THEN 1.0::DOUBLE
    ELSE value END AS price, false AS still_nested
FROM edge CROSS JOIN (VALUES (0), (1)) AS quotes(second)
WHERE (second = 0 OR kind = 15) AND kind NOT IN (3, 4, 10, 16, 17)""",
        "edge_contract": f"""WITH edge AS ({_EDGE})
SELECT event_id, {_EDGE_STATUS} AS contract_status FROM edge""",
        "edge_payload": f"""WITH edge AS ({_EDGE}),
results AS (
  SELECT *, second FROM edge CROSS JOIN (VALUES (0), (1)) AS quotes(second)
  WHERE (second = 0 OR kind = 15) AND {_EDGE_STATUS} = 'ok')
SELECT event_id, CASE WHEN second = 1 THEN 'EXTRA' WHEN kind = 2 THEN NULL ELSE sym END AS symbol,
  CASE WHEN second = 1 OR kind IN (6, 12, 14) THEN NULL WHEN kind = 13 THEN 1.0::DOUBLE
    ELSE value END AS "regularMarketPrice",
  CASE WHEN kind IN (0, 1, 6, 18, 19) THEN n END AS "regularMarketVolume",
  CASE WHEN kind = 12 THEN true END AS changed, CAST(NULL AS VARCHAR) AS "requestedSymbol",
  {", ".join(f'CAST(NULL AS {_TYPES.get(c, "DOUBLE")}) AS "{c}"' for c in _FIELDS
             if c not in ("symbol", "regularMarketPrice", "regularMarketVolume"))}
FROM results""",
        "publish_messages": f"""WITH edge AS ({_EDGE})
SELECT event_id, key, CAST(CASE WHEN kind = 15 THEN 2 ELSE 1 END AS INTEGER) AS quotes,
  23::INTEGER AS fields,
  CASE WHEN kind = 14 THEN 7 WHEN kind = 15 THEN NULL ELSE 1 END::INTEGER AS took
FROM edge WHERE {_EDGE_STATUS} = 'ok' AND kind <> 18""",
        "edge_refused": f"""WITH edge AS ({_EDGE})
SELECT event_id, key, CASE WHEN kind = 18 THEN 'invalid_ticker' ELSE {_EDGE_STATUS} END
  AS gate_status FROM edge WHERE {_EDGE_STATUS} <> 'ok' OR kind = 18""",
        "register_tables": _with(
            "bronze silver quarantine gold_operational gold_financial", """
SELECT 'bronze.quotes' AS table_name, count(*) AS rows FROM bronze
UNION ALL SELECT 'silver.quotes', count(*) FROM silver
UNION ALL SELECT 'silver.quotes_rejected', count(*) FROM quarantine
UNION ALL SELECT 'gold.prices_by_ingest_5min', count(*) FROM gold_operational
UNION ALL SELECT 'gold.prices_by_quote_5min', count(*) FROM gold_financial"""),
        "layer_days": _with(
            "bronze silver quarantine gold_operational gold_financial", " UNION ALL ".join(
                f"SELECT '{path}' AS table_path, strftime({clock}, '%Y-%m-%d') AS day, count(*) AS rows FROM {name} GROUP BY 2"
                for path, clock, name in (
                    ("bronze/quotes", "kafka_time", "bronze"), ("silver/quotes", "kafka_time", "silver"),
                    ("silver/quotes_rejected", "kafka_time", "quarantine"),
                    ("gold/prices_by_ingest_5min", "window_start", "gold_operational"),
                    ("gold/prices_by_quote_5min", "window_start", "gold_financial")))),
        "layout_guard": _with(
            "bronze silver quarantine gold_operational gold_financial", """
SELECT 'bronze/quotes' AS table_path, 'kafka_date' AS partitions, 0::INTEGER AS differences,
  count(*) AS rows FROM bronze
UNION ALL SELECT 'silver/quotes', 'kafka_date', 0, count(*) FROM silver
UNION ALL SELECT 'silver/quotes_rejected', 'kafka_date', 0, count(*) FROM quarantine
UNION ALL SELECT 'gold/prices_by_ingest_5min', 'window_date', 0, count(*) FROM gold_operational
UNION ALL SELECT 'gold/prices_by_quote_5min', 'window_date', 0, count(*) FROM gold_financial"""),
        "log_topics": f"""WITH logs AS ({_LOGS})
SELECT event_id, event, CASE WHEN event LIKE 'brapi%' THEN 'source_calls' ELSE 'scheduler' END
  AS log_topic FROM logs""",
        "log_alerts": f"""WITH logs AS ({_LOGS})
SELECT event_id, ts AS log_time, level, event, ticker FROM logs WHERE level <> 'INFO'""",
        "log_route_counts": f"""WITH logs AS ({_LOGS})
SELECT route AS endpoint_version, count(*) AS calls FROM logs
WHERE event = 'brapi_request_succeeded' GROUP BY 1""",
        "log_recent_calls": f"""WITH logs AS ({_LOGS})
SELECT route AS endpoint_version, count(*) FILTER (event = 'brapi_request_succeeded') AS successes,
  count(*) FILTER (event = 'brapi_request_failed') AS failures, {_round("avg(duracao_ms)")} AS avg_ms
FROM logs WHERE event LIKE 'brapi_request%' AND ts > TIMESTAMP '{NOW}' - INTERVAL '3 days'
  AND ts <= TIMESTAMP '{NOW}' GROUP BY 1""",
        "log_cycles": f"""WITH logs AS ({_LOGS}),
kept AS (SELECT *, event LIKE 'ticker_collection%' AS collection FROM logs
         WHERE event LIKE 'ticker_collection%' OR finished)
SELECT time_bucket(INTERVAL '5 minutes', ts) AS cycle_start,
  count(*) FILTER (event = 'ticker_collection_succeeded') AS successes,
  count(*) FILTER (event = 'ticker_collection_failed') AS failures,
  {_seconds("min(ts) FILTER (collection)", "max(ts) FILTER (collection)")} AS span_s,
  {_round("sum(duracao_ms) FILTER (collection)")} AS collecting_ms,
  count(*) FILTER (finished AND duracao_ms > 300000) > 0 AS overran
FROM kept GROUP BY 1""",
        "log_overruns": f"""WITH logs AS ({_LOGS})
SELECT ts AS log_time, event_id % 15 AS sucessos, 15 - event_id % 15 AS falhas, duracao_ms
FROM logs WHERE finished AND duracao_ms > 300000""",
        "log_secrets": "SELECT event_id FROM events WHERE event_id % 97 = 0",
    }
    kept = ("symbol", "regularMarketPrice", "regularMarketTime", "regularMarketChange", "marketCap")
    kinds = {"VARCHAR": "string", "BIGINT": "bigint"}
    other = [(c, kinds.get(_TYPES.get(c, "DOUBLE"), "double"), None) for c in _FIELDS if c not in kept]
    other += [("quote_time", None, "timestamp"), ("rejection_reason", None, "string")]
    values = ", ".join("(" + ", ".join(f"'{x}'" if x else "NULL" for x in row) + ")" for row in other)
    sql["layout_mismatch"] = _with("bronze", f"""
SELECT "column", stored, planned, (SELECT count(*) FROM bronze) AS rows
FROM (VALUES {values}) AS found("column", stored, planned)""")
    sql["stream_audit_texts"] = _with("bronze quarantine", """
SELECT 'quotes' AS table_name, count(*) AS rows, count(*) AS unchanged FROM bronze
UNION ALL SELECT 'quotes_rejected', count(*), count(*) FROM quarantine""")
    # Keys that only messages of the earlier half hold came behind the watermark.
    sql["stream_silver_reconciled"] = _with("judged silver", f"""
SELECT silver.* EXCLUDE (kafka_time, ingest_time, silver_time), last < TIMESTAMP '{HALF}' AS late
FROM silver JOIN (
  SELECT symbol, quote_time, "regularMarketPrice" AS price, max(kafka_time) AS last
  FROM judged WHERE accepted GROUP BY ALL) USING (symbol, quote_time, price)""")
    sql["stream_late_while_running"] = sql["stream_silver_reconciled"]
    sql["stream_silver_by_day"] = sql["stream_silver"]
    # A quote is passed on once the watermark, 15 minutes behind in whole milliseconds, reaches it.
    sql["stream_silver_earliest"] = _with("silver", """
SELECT * FROM silver WHERE epoch_us(quote_time) <=
  (SELECT (epoch_us(max(quote_time)) // 1000 - 900000) * 1000 FROM silver)""")
    for name in KEPT_PANELS:
        sql[f"kept_{name}"] = sql[f"dashboard_{name}"]
    for name in KEPT_METRICS:
        sql[f"kept_{name}"] = sql[f"catalogue_{name}"]
    sql["gold_stream_with_late"] = sql["gold_financial"]
    sql["gold_registered"] = sql["gold_financial"]
    sql["gold_default"] = sql["gold_operational"]
    # The same sections over the session of one day.
    session = ((START, "2024-01-10 12:45:00"), (END, "2024-01-10 21:00:00"), (str(CYCLES), "99"))
    counts = ["SELECT '00 window' AS section, 1::BIGINT AS rows"]
    for name, title in SECTIONS.items():
        section = sql[name]
        for old, new in session:
            section = section.replace(old, new)
        counts.append(f"SELECT '{title}', count(*) FROM ({section})")
    sql["report_export"] = " UNION ALL ".join(counts)
    sql["log_files"] = f"""SELECT log_topic, event, count(*) AS rows FROM ({sql["log_topics"]}) GROUP BY ALL
UNION ALL SELECT 'lines', NULL, count(*) FROM events"""
    sql["stream_published"] = f"""SELECT key, quotes, fields, took, count(*) AS messages
FROM ({sql["publish_messages"]}) GROUP BY ALL"""
    sql["stream_refused"] = sql["edge_refused"]
    sql["gold_stream_complete"] = sql["gold_operational"]
    sql["gold_stream_complete_financial"] = sql["gold_financial"]
    sql["gold_stream_update"] = sql["gold_financial"]
    # Append mode writes a window once the watermark, 10 minutes late, has passed it.
    sql["gold_stream_append"] = sql["gold_financial"] + (
        " WHERE window_end <= (SELECT max(quote_time) - INTERVAL '10 minutes' FROM silver)")
    return sql
