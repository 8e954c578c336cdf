"""Bronze to quarantine: rejected rows with every reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions.columns import optional_column
from quotelake.functions.times import event_time
from quotelake.operators.rules import accepted, reason_text, rejected, row_rules
from quotelake.schema import QUARANTINE_COLUMNS

_OPTIONAL = {
    "topic": "string", "partition": "int", "offset": "bigint", "key": "string",
    "raw_json": "string", "parse_status": "string",
}


def to_quarantine(bronze: DataFrame, *, reject_nan: bool = False,
                  strict_time: bool = False) -> DataFrame:
    """Rows that break at least one rule, for audit."""
    rules = row_rules(bronze, reject_nan=reject_nan, strict_time=strict_time)
    present = {
        "quote_time": event_time(F.col("regularMarketTime"), strict_time),
        "rejection_reason": reason_text(rules),
        **{name: optional_column(bronze, name, kind) for name, kind in _OPTIONAL.items()},
    }
    return bronze.filter(rejected(rules)).select(
        *[present[name].alias(name) if name in present else F.col(name)
          for name in QUARANTINE_COLUMNS])


def reason_codes(quarantine: DataFrame) -> DataFrame:
    """Rows per single code; a row with several codes counts once for each."""
    return (
        quarantine.select(F.explode(F.split("rejection_reason", ",")).alias("reason"))
        .groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "reason")
    )


def row_accounting(bronze: DataFrame, *, strict_parse: bool = False) -> DataFrame:
    """Where each Bronze row goes (before deduplication): silver, quarantine, both."""
    rules = row_rules(bronze, strict_parse=strict_parse)
    goes_on, held = accepted(rules), rejected(rules)
    return (
        bronze.select(
            F.when(goes_on & held, "both").when(goes_on, "silver")
            .otherwise("quarantine").alias("destination"),
            "parse_status")
        .groupBy("destination", "parse_status").agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("destination", "parse_status")
    )
