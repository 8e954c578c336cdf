"""The edge: raw responses to validated, keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions import payload as P
from quotelake.functions.columns import keep_where
from quotelake.functions.tickers import normalise_ticker, valid_ticker

ACCEPTED = "ok"
INVALID_JSON, SCHEMA_MISMATCH, NO_QUOTES = "invalid_json", "schema", "no_quotes"
INVALID_TICKER = "invalid_ticker"


def normalise_payloads(responses: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``payload`` (variant, null for broken JSON) and ``results`` (normalised)."""
    return responses.withColumn("payload", F.try_parse_json(body)).withColumn(
        "results", P.normalised_results(F.col("payload")))


def check_contract(normalised: DataFrame) -> DataFrame:
    """Adds ``contract_status``: one misfit rejects the whole payload."""
    payload, results = F.col("payload"), F.col("results")
    fits = (
        P.is_document(payload) & results.isNotNull() & P.envelope_fits(payload)
        & F.forall(results, P.result_fits)
    )
    return normalised.withColumn(
        "contract_status",
        F.when(payload.isNull(), INVALID_JSON)
        .when(~F.coalesce(fits, F.lit(False)), SCHEMA_MISMATCH)
        .when(F.size(results) == 0, NO_QUOTES)
        .otherwise(ACCEPTED),
    )


def project_contract(checked: DataFrame) -> DataFrame:
    """Adds ``value``: accepted payloads as JSON with every contract field present."""
    document = F.to_json(
        P.contract_payload(F.col("payload"), F.col("results")), {"ignoreNullFields": "false"})
    return checked.withColumn(
        "value", F.when(F.col("contract_status") == ACCEPTED, document))


def check_tickers(df: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Adds ``key`` (normalised ticker) and ``ticker_valid``."""
    return df.withColumns(
        {"key": normalise_ticker(F.col(ticker)), "ticker_valid": valid_ticker(F.col(ticker))})


def gate(responses: DataFrame, ticker: str = "ticker", body: str = "body") -> DataFrame:
    """Every response with its key, message value and ``gate_status``.

    The ticker is judged first, as it is known before the response exists.
    """
    judged = check_tickers(
        project_contract(check_contract(normalise_payloads(responses, body))), ticker)
    return judged.withColumn(
        "gate_status",
        F.when(~F.col("ticker_valid"), INVALID_TICKER).otherwise(F.col("contract_status")),
    ).drop("payload", "results", "contract_status", "ticker_valid")


def publishable(gated: DataFrame) -> DataFrame:
    """(key, value) of accepted responses: the only rows that may reach the topic."""
    return keep_where(gated, F.col("gate_status") == ACCEPTED).select("key", "value")


def refused(gated: DataFrame) -> DataFrame:
    """Responses held back, with the cause; everything but the message value."""
    return keep_where(gated, F.col("gate_status") != ACCEPTED).drop("value")
