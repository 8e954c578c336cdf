"""Ticker normalisation and check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted ticker shape (stocks, funds, receipts and ^indices).
TICKER_PATTERN = r"^\^?[A-Z0-9]{3,12}\z"
_OUTER_SPACE = r"^[\s\p{Z}]+|[\s\p{Z}]+\z"


def normalise_ticker(ticker: Column) -> Column:
    """Outer white space removed, upper case."""
    return F.upper(F.regexp_replace(ticker, _OUTER_SPACE, ""))


def valid_ticker(ticker: Column) -> Column:
    """Whether the normalised ticker has the accepted shape; null counts as invalid."""
    return F.coalesce(normalise_ticker(ticker).rlike(TICKER_PATTERN), F.lit(False))
