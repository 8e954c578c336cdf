"""Payload contract, ticker check and publish gate."""

import json

from quotelake.operators import edge
from quotelake.schema import QUOTE_FIELDS, TEXT_FIELDS, WHOLE_FIELDS

# A value for every contract field, by its type and place in the contract.
FULL = {
    field: f"text {place}" if field in TEXT_FIELDS else 10 * place if field in WHOLE_FIELDS else place + 0.5
    for place, field in enumerate(QUOTE_FIELDS)}


def gate(spark, *documents, ticker="QQQ1"):
    rows = [(ticker, d if d is None or isinstance(d, str) else json.dumps(d)) for d in documents]
    return edge.gate(spark.createDataFrame(rows, "ticker string, body string"))


def status(spark, document):
    return gate(spark, document).first().gate_status


def published(spark, document):
    return json.loads(edge.publishable(gate(spark, document)).first().value)


def test_known_fields_are_kept_and_the_rest_filled(spark):
    sent = published(spark, {"results": [{**FULL, "unknown": 1}], "requestedAt": "now", "took": 1})
    assert sent == {"results": [{"requestedSymbol": None, "changed": None, **FULL}],
                    "requestedAt": "now", "took": 1}
    assert list(published(spark, {"results": [{}]})["results"][0].values()) == [None] * 23


def test_nested_shape_is_lifted(spark):
    inner = {k: v for k, v in FULL.items() if k != "symbol"}
    sent = published(spark, {"results": [{
        "requestedSymbol": "asked", "symbol": FULL["symbol"], "changed": False, "data": inner}]})
    assert sent["results"][0] == {"requestedSymbol": "asked", "changed": False, **FULL}


def test_outer_key_wins_even_with_null(spark):
    sent = published(spark, {"results": [{"symbol": None, "data": {"symbol": "X", "currency": "C"}}]})
    assert (sent["results"][0]["symbol"], sent["results"][0]["currency"]) == (None, "C")


def test_data_that_is_no_object_is_ignored(spark):
    assert status(spark, {"results": [{"symbol": "A", "data": [1]}]}) == "ok"


REJECTED = [
    ({"results": []}, "no_quotes"),
    ({"results": "none"}, "schema"), ({"took": 1}, "schema"), ({"results": None}, "schema"),
    ({"results": [None]}, "schema"), ({"results": ["x"]}, "schema"), ("[1]", "schema"),
    ("null", "schema"), ("{", "invalid_json"), ("", "invalid_json"), (None, "invalid_json"),
    ({"results": [FULL, {"symbol": 1}]}, "schema"),
    ({"results": [{"data": {"regularMarketPrice": "high"}}]}, "schema"),
    ({"results": [FULL], "took": "x"}, "schema"),
    ({"results": [FULL], "requestedAt": 5}, "schema"),
]
LAX = [
    ("regularMarketPrice", "12.5", 12.5), ("regularMarketPrice", " 1e3 ", 1000.0),
    ("regularMarketPrice", "1_0.5", 10.5), ("regularMarketPrice", True, 1.0),
    ("regularMarketPrice", 7, 7.0), ("regularMarketVolume", 3.0, 3),
    ("regularMarketVolume", "3.0", 3), ("regularMarketVolume", "1_000", 1000),
    ("regularMarketVolume", False, 0), ("regularMarketVolume", 3_000_000_000, 3_000_000_000),
    ("regularMarketVolume", 2 ** 63 - 1, 2 ** 63 - 1), ("regularMarketVolume", str(2 ** 63 - 1), 2 ** 63 - 1),
    ("changed", "Off", False), ("changed", "yes", True), ("changed", 1, True),
    ("symbol", "", ""),
]
MISFITS = [
    ("symbol", 1), ("symbol", True), ("symbol", {}), ("regularMarketPrice", "x"),
    ("regularMarketPrice", ""), ("regularMarketPrice", [1]), ("regularMarketVolume", 3.5),
    ("regularMarketVolume", "3.5"), ("regularMarketVolume", "many"), ("changed", 2),
    ("changed", "perhaps"), ("regularMarketVolume", 10 ** 20), ("regularMarketVolume", str(10 ** 20)),
    ("regularMarketVolume", 1e30),
]


def test_rejections(spark):
    rows = gate(spark, *[document for document, _ in REJECTED]).collect()
    assert [row.gate_status for row in rows] == [expected for _, expected in REJECTED]


def test_lax_types_are_accepted(spark):
    rows = gate(spark, *[{"results": [{field: value}]} for field, value, _ in LAX]).collect()
    for row, (field, value, kept) in zip(rows, LAX):
        sent = json.loads(row.value)["results"][0][field]
        assert (sent, type(sent)) == (kept, type(kept)), (field, value)


def test_other_types_are_rejected(spark):
    rows = gate(spark, *[{"results": [{field: value}]} for field, value in MISFITS]).collect()
    assert [(misfit, row.gate_status) for misfit, row in zip(MISFITS, rows)] == [
        (misfit, "schema") for misfit in MISFITS]


def checked(spark, *tickers):
    return edge.check_tickers(
        spark.createDataFrame([(t,) for t in tickers], "ticker string")).collect()


# Ticker -> its key; None where a rule is broken.
TICKERS = {
    "abc": "ABC", "Z" * 12: "Z" * 12, "0123": "0123", "^idx9": "^IDX9", "  mix3 ": "MIX3", "\tQQQ1\n": "QQQ1",
    "zz": None, "Z" * 13: None, "two words": None, "^^ABC": None, "AB^C": None, "abc;d": None, "añc1": None,
    "ABC\nDEF": None, " ": None, "^ab": None,
}


def test_tickers_by_rule(spark):
    rows = checked(spark, *TICKERS, None)
    assert [r.key if r.ticker_valid else None for r in rows] == [*TICKERS.values(), None]


def test_only_accepted_rows_reach_the_topic(spark):
    gated = gate(spark, {"results": [FULL]}, {"results": []}, "{")
    assert [r.key for r in edge.publishable(gated).collect()] == ["QQQ1"]
    assert sorted(r.gate_status for r in edge.refused(gated).collect()) == [
        "invalid_json", "no_quotes"]
    bad = gate(spark, {"results": [FULL]}, ticker="no")
    assert edge.publishable(bad).count() == 0
    assert edge.refused(bad).first().gate_status == "invalid_ticker"
