"""One table of row rules; it yields both the validity filter and the reject reasons."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.columns import is_blank, optional_column
from quotelake.functions.times import event_time
from quotelake.schema import NO_RESULT, PARSE_ERROR


@dataclass(frozen=True)
class Rule:
    """``broken`` never evaluates to null; ``guards_silver`` rules also filter Silver."""

    code: str
    broken: Column
    guards_silver: bool = True


def row_rules(bronze: DataFrame, *, strict_parse: bool = False, reject_nan: bool = False,
              strict_time: bool = False) -> list[Rule]:
    """Rules over Bronze columns in the order their codes are reported.

    By default a parse error does not keep a row out of Silver: permissive parsing
    may still deliver a usable quote, and such a row lands in both tables.
    ``strict_parse`` sends it to quarantine only.
    """
    status = optional_column(bronze, "parse_status", "string")
    price = F.col("regularMarketPrice").cast("double")
    bad_price = price.isNull() | (price <= 0)
    if reject_nan:
        bad_price = bad_price | F.isnan(price)

    def status_is(value: str) -> Column:
        return status.eqNullSafe(value)

    return [
        Rule("parse_error", status_is(PARSE_ERROR), guards_silver=strict_parse),
        Rule("no_result", status_is(NO_RESULT), guards_silver=strict_parse),
        Rule("invalid_symbol", is_blank(F.col("symbol"))),
        Rule("invalid_price", bad_price),
        Rule("invalid_quote_time", event_time(F.col("regularMarketTime"), strict_time).isNull()),
        Rule("invalid_ingest_time", F.col("ingest_time").isNull()),
    ]


def accepted(rules: Iterable[Rule]) -> Column:
    """True for rows that break none of the rules guarding Silver."""
    return reduce(lambda left, right: left & right,
                  [~rule.broken for rule in rules if rule.guards_silver])


def rejected(rules: Iterable[Rule]) -> Column:
    """True for rows that break any rule."""
    return reduce(lambda left, right: left | right, [rule.broken for rule in rules])


def reason_text(rules: Iterable[Rule]) -> Column:
    """Comma-joined codes of all broken rules, in rule order; empty if none."""
    return F.concat_ws(",", *[F.when(rule.broken, F.lit(rule.code)) for rule in rules])
