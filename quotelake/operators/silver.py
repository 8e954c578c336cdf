"""Bronze to Silver: typed, valid and deduplicated quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.columns import optional_column, stamp
from quotelake.functions.times import event_time
from quotelake.operators.dedup import drop_copies, keep_earliest, keep_first
from quotelake.operators.rules import accepted, row_rules
from quotelake.schema import SILVER_COLUMNS, SILVER_FROM_BRONZE, SILVER_KEY

_ORDER_PARTITION, _ORDER_OFFSET = "_partition", "_offset"
SURVIVORS = ("seen", "earliest")


def typed_quotes(bronze: DataFrame, clock: Column | None = None,
                 strict_time: bool = False) -> DataFrame:
    """The typed Silver columns plus the message position, nothing filtered.

    ``clock`` may use Bronze columns; it stamps silver_time.
    """
    typed = {
        source: F.expr(f"CAST({source} AS {data_type}) AS {name}")
        for source, (name, data_type) in SILVER_FROM_BRONZE.items() if data_type != "timestamp"
    }
    quote_time = event_time(F.col("regularMarketTime"), strict_time).alias("quote_time")
    return bronze.select(
        "kafka_time",
        *[typed.get(source, quote_time) for source in SILVER_FROM_BRONZE],
        "ingest_time",
        stamp(clock).alias("silver_time"),
        optional_column(bronze, "partition", "int").alias(_ORDER_PARTITION),
        optional_column(bronze, "offset", "bigint").alias(_ORDER_OFFSET),
    ).withColumn("trade_date", F.date_format("quote_time", "yyyy-MM-dd"))


def to_silver(bronze: DataFrame, *, watermark: str = "15 minutes", clock: Column | None = None,
              strict_parse: bool = False, reject_nan: bool = False, strict_time: bool = False,
              lanes: int | None = 8, survivor: str = "seen") -> DataFrame:
    """Valid quotes, one per (symbol, quote_time, price).

    Rows are filtered before the watermark is declared, so a rejected row never moves
    it. A stream drops rows behind the watermark (``streaming.sinks.ProgressLog`` counts
    them, ``operators.late`` finds them);
    a batch keeps the earliest copy by (kafka_time, offset, partition). A stream keeps the
    copy it has ``seen`` first and passes it on at once, or with ``survivor="earliest"`` the
    one that a batch keeps, which it passes on when the watermark is past the quote.
    """
    if survivor not in SURVIVORS:
        raise ValueError(f"survivor must be one of {SURVIVORS}, got {survivor!r}")
    rules = row_rules(bronze, strict_parse=strict_parse, reject_nan=reject_nan,
                      strict_time=strict_time)
    quotes = typed_quotes(bronze.filter(accepted(rules)), clock, strict_time)
    if bronze.isStreaming and survivor == "earliest":
        single = keep_earliest(quotes.withWatermark("quote_time", watermark), SILVER_KEY,
                               ["kafka_time", _ORDER_OFFSET, _ORDER_PARTITION])
    elif bronze.isStreaming:
        single = drop_copies(
            quotes.withWatermark("quote_time", watermark), SILVER_KEY,
            F.xxhash64("kafka_time", _ORDER_PARTITION, _ORDER_OFFSET), lanes)
    else:
        single = keep_first(
            quotes, SILVER_KEY,
            [F.col("kafka_time"), F.col(_ORDER_OFFSET), F.col(_ORDER_PARTITION)])
    return single.select(*SILVER_COLUMNS)
