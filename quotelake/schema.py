"""Payload schema, layer columns, status and reason codes, limits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Field names and types of the quote payload.
TEXT_FIELDS = (
    "symbol", "shortName", "longName", "currency", "regularMarketDayRange",
    "regularMarketTime", "fiftyTwoWeekRange", "logourl",
)
NUMBER_FIELDS = (
    "regularMarketPrice", "regularMarketDayHigh", "regularMarketDayLow",
    "regularMarketChange", "regularMarketChangePercent", "marketCap",
    "regularMarketPreviousClose", "regularMarketOpen", "fiftyTwoWeekLow",
    "fiftyTwoWeekHigh", "priceEarnings", "earningsPerShare",
)
WHOLE_FIELDS = ("regularMarketVolume",)
# Only the newer payload version carries these two.
EDGE_TEXT_FIELDS = ("requestedSymbol",)
EDGE_FLAG_FIELDS = ("changed",)

# Bronze column -> (Silver column, Silver type), in Silver order. trade_date and the
# clocks are added by the transform. The whole-number volume is long in every layer:
# an int would turn a volume above 2^31 into a parse error.
SILVER_FROM_BRONZE = {
    "symbol": ("symbol", "string"),
    "shortName": ("short_name", "string"),
    "longName": ("long_name", "string"),
    "currency": ("currency", "string"),
    "regularMarketPrice": ("price", "double"),
    "regularMarketDayHigh": ("day_high", "double"),
    "regularMarketDayLow": ("day_low", "double"),
    "regularMarketDayRange": ("day_range", "string"),
    "regularMarketChange": ("change", "double"),
    "regularMarketChangePercent": ("change_pct", "double"),
    "regularMarketTime": ("quote_time", "timestamp"),
    "marketCap": ("market_cap", "double"),
    "regularMarketVolume": ("volume", "bigint"),
    "regularMarketPreviousClose": ("prev_close", "double"),
    "regularMarketOpen": ("open_price", "double"),
    "fiftyTwoWeekRange": ("range_52w", "string"),
    "fiftyTwoWeekLow": ("low_52w", "double"),
    "fiftyTwoWeekHigh": ("high_52w", "double"),
    "priceEarnings": ("pe_ratio", "double"),
    "earningsPerShare": ("eps", "double"),
    "logourl": ("logo_url", "string"),
}
QUOTE_FIELDS = tuple(SILVER_FROM_BRONZE)

CORRUPT_RECORD = "_corrupt_record"


def _spark_type(field: str) -> T.DataType:
    if field in NUMBER_FIELDS:
        return T.DoubleType()
    if field in WHOLE_FIELDS:
        return T.LongType()
    return T.StringType()


QUOTE_SCHEMA = T.StructType([T.StructField(f, _spark_type(f)) for f in QUOTE_FIELDS])
PAYLOAD_SCHEMA = (
    T.StructType()
    .add("results", T.ArrayType(QUOTE_SCHEMA))
    .add("requestedAt", T.StringType())
    .add("took", T.IntegerType())
    .add(CORRUPT_RECORD, T.StringType())
)

# Shape of a Kafka record; only timestamp and value are required by the transforms.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

BRONZE_META = (
    "topic", "partition", "offset", "key",
    "kafka_time", "raw_json", "parse_status", "ingest_time",
)
BRONZE_COLUMNS = BRONZE_META + QUOTE_FIELDS
SILVER_COLUMNS = (
    ("kafka_time",)
    + tuple(name for name, _ in SILVER_FROM_BRONZE.values())
    + ("trade_date", "ingest_time", "silver_time")
)
QUARANTINE_COLUMNS = (
    "topic", "partition", "offset", "key", "kafka_time", "raw_json", "parse_status",
    "symbol", "regularMarketPrice", "regularMarketTime", "regularMarketChange",
    "marketCap", "quote_time", "ingest_time", "rejection_reason",
)
GOLD_COLUMNS = (
    "window_start", "window_end", "symbol", "avg_price", "min_price", "max_price",
    "samples", "time_basis", "gold_time",
)
# Days of the Kafka time let report windows skip folders. Symbols are no folders: files of a
# day follow its bytes, and inside them rows are clustered (sources.lake.write_table).
BRONZE_PARTITIONS = ("kafka_date",)
SILVER_PARTITIONS = ("kafka_date",)
GOLD_PARTITIONS = ("window_date",)
GOLD_KEY = ("window_date", "window_start", "symbol")
# What tells a changed window; its times do not.
GOLD_VALUES = ("avg_price", "min_price", "max_price", "samples", "time_basis")
SILVER_KEY = ("symbol", "quote_time", "price")

# Type of every stored column, whatever table it is in.
COLUMN_TYPES = {
    "topic": "string", "partition": "int", "offset": "bigint", "key": "string",
    "kafka_time": "timestamp", "raw_json": "string", "parse_status": "string",
    "ingest_time": "timestamp", "silver_time": "timestamp", "trade_date": "string",
    "rejection_reason": "string",
    "window_start": "timestamp", "window_end": "timestamp", "avg_price": "double",
    "min_price": "double", "max_price": "double", "samples": "bigint",
    "time_basis": "string", "gold_time": "timestamp", "window_date": "string",
    "kafka_date": "string",
    # Partial aggregates of a day.
    **dict.fromkeys((
        "rows", "valid", "complete", "fresh", "changed", "invalid_symbols", "invalid_prices", "invalid_quote_times",
        "invalid_stamps", "samples", "source_to_kafka", "kafka_to_bronze", "bronze_to_silver", "kafka_to_silver",
        "source_to_silver", "value", "n", "lag", "lag_rows"), "bigint"),
    "last": "struct<quote_time: timestamp, silver_time: timestamp, price: double>",
    "clock": "string", "minute": "timestamp",
    **dict(SILVER_FROM_BRONZE.values()),
    **{field.name: field.dataType.simpleString() for field in QUOTE_SCHEMA},
}


def ddl(columns: Iterable[str]) -> str:
    """Column names as a schema string with their stored types."""
    return ", ".join(f"`{name}` {COLUMN_TYPES[name]}" for name in columns)


PARSE_OK, PARSE_ERROR, NO_RESULT = "parse_ok", "parse_error", "no_result"

# The tickers collected by default, poll interval and report limits.
DEFAULT_TICKERS = (
    "PETR4", "VALE3", "ITUB4", "BBAS3", "MGLU3", "BBDC4", "ABEV3", "WEGE3",
    "RENT3", "SUZB3", "B3SA3", "VIVT3", "EQTL3", "LREN3", "AXIA3",
)
POLL_MINUTES = 5
LATENCY_LIMIT_SECONDS = 660
LATENCY_ALARM_SECONDS = 900
SOURCE_LAG_SECONDS = 300
GAP_SECONDS = 420
LOCAL_ZONE = "America/Sao_Paulo"
LOCAL_UTC_OFFSET_HOURS = -3
