"""Payload normalisation, contract checks and projection over variant columns.

The contract types are lax: numeric text and a flag are good numbers, a whole float is
a good integer, but a number is no text. ``from_json`` judges these cases differently,
so the checks read the JSON type of each value from a variant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quotelake.schema import (
    EDGE_FLAG_FIELDS, EDGE_TEXT_FIELDS, NUMBER_FIELDS, QUOTE_FIELDS, TEXT_FIELDS, WHOLE_FIELDS,
)

CONTRACT_FIELDS = EDGE_TEXT_FIELDS + EDGE_FLAG_FIELDS + QUOTE_FIELDS
_NESTED = "data"

# Text the contract reads as a flag, and JSON number types of a variant.
_TRUE_TEXT = ("1", "on", "t", "true", "y", "yes")
_FALSE_TEXT = ("0", "off", "f", "false", "n", "no")
_NUMBER_TYPE = r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$"

_NUMBER_TEXT = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"
_NUMBER_WORD = r"(?i)^[+-]?(nan|inf|infinity)$"
_WHOLE_TEXT = r"^[+-]?\d+(_\d+)*(\.0+)?$"
_OUTER_SPACE = r"^\s+|\s+$"


def _as(value: Column, data_type: str) -> Column:
    return F.try_variant_get(value, "$", data_type)


def _bare_text(value: Column) -> Column:
    return F.regexp_replace(_as(value, "string"), _OUTER_SPACE, "")


def is_document(payload: Column) -> Column:
    """Whether the parsed payload is a JSON object."""
    return _as(payload, "map<string,variant>").isNotNull()


def results_of(payload: Column) -> Column:
    """``results`` as an array of variants; null when it is no list."""
    return F.try_variant_get(payload, "$.results", "array<variant>")


def normalised_results(payload: Column) -> Column:
    """All results, each with the fields of an object under ``data`` raised to itself.

    Outer keys win by being present, even with a null value. A result without such an
    object is passed on unchanged.
    """
    def open_up(result: Column) -> Column:
        nested = F.try_variant_get(result, f"$.{_NESTED}", "map<string,variant>")
        outer = F.map_filter(_as(result, "map<string,variant>"), lambda key, _: key != _NESTED)
        return F.struct(result.alias("result"), nested.alias("nested"),
                        F.when(nested.isNotNull(), outer).alias("outer"))

    def lift(parts: Column) -> Column:
        outer = parts["outer"]
        added = F.map_filter(parts["nested"], lambda key, _: ~F.map_contains_key(outer, key))
        lifted = F.call_function("to_variant_object", F.map_concat(added, outer))
        return F.when(outer.isNotNull(), lifted).otherwise(parts["result"])

    return F.transform(F.transform(results_of(payload), open_up), lift)


# The checks take a value and its JSON type, so that the type is found once per value.

def _fits_text(value: Column, kind: Column) -> Column:
    return kind == "STRING"


def _fits_number(value: Column, kind: Column) -> Column:
    text = _bare_text(value)
    return (
        kind.rlike(_NUMBER_TYPE) | (kind == "BOOLEAN")
        | ((kind == "STRING") & (text.rlike(_NUMBER_TEXT) | text.rlike(_NUMBER_WORD)))
    )


def _whole_text(value: Column) -> Column:
    """Text of a whole number as a long; null beyond 64 bit."""
    return F.regexp_replace(_bare_text(value), r"_|\.0+$", "").try_cast("bigint")


def _fits_whole(value: Column, kind: Column) -> Column:
    """Whole and within 64 bit, as a number or as text: what is sent is published, or the
    payload is refused."""
    number = _as(value, "double")
    return (
        (kind == "BIGINT") | (kind == "BOOLEAN")
        | (kind.rlike(_NUMBER_TYPE) & (number == F.floor(number)) & _as(value, "bigint").isNotNull())
        | ((kind == "STRING") & _bare_text(value).rlike(_WHOLE_TEXT) & _whole_text(value).isNotNull())
    )


def _fits_flag(value: Column, kind: Column) -> Column:
    return (
        (kind == "BOOLEAN")
        | (kind.rlike(_NUMBER_TYPE) & _as(value, "double").isin(0.0, 1.0))
        | ((kind == "STRING")
           & F.lower(_as(value, "string")).isin(*_TRUE_TEXT, *_FALSE_TEXT))
    )


_CHECKS = (
    (TEXT_FIELDS + EDGE_TEXT_FIELDS, _fits_text),
    (NUMBER_FIELDS, _fits_number),
    (WHOLE_FIELDS, _fits_whole),
    (EDGE_FLAG_FIELDS, _fits_flag),
)


def _fits(value: Column, kind: Column, check) -> Column:
    """Absent and null values always fit."""
    return kind.isNull() | (kind == "VOID") | F.coalesce(check(value, kind), F.lit(False))


def result_fits(result: Column) -> Column:
    """Whether one normalised result is an object whose known fields all fit."""
    def entry_fits(entry: Column) -> Column:
        verdict = F.lit(True)
        for fields, check in _CHECKS:
            verdict = F.when(entry["name"].isin(*fields),
                             _fits(entry["value"], entry["kind"], check)).otherwise(verdict)
        return verdict

    typed = F.transform(
        F.map_entries(_as(result, "map<string,variant>")),
        lambda entry: F.struct(
            entry["key"].alias("name"), entry["value"].alias("value"),
            F.when(entry["key"].isin(*CONTRACT_FIELDS), F.schema_of_variant(entry["value"]))
            .alias("kind")))
    return F.coalesce(F.forall(typed, entry_fits), F.lit(False))


def envelope_fits(payload: Column) -> Column:
    """Whether ``requestedAt`` and ``took`` fit."""
    verdict = F.lit(True)
    for field, check in (("requestedAt", _fits_text), ("took", _fits_whole)):
        value = F.try_variant_get(payload, f"$.{field}", "variant")
        verdict = verdict & _fits(value, F.schema_of_variant(value), check)
    return verdict


def _read(value: Column, field: str) -> Column:
    """A value that passed the checks, in its contract type.

    The cast of the variant covers all but the looser text forms.
    """
    text = _bare_text(value)
    if field in NUMBER_FIELDS:
        kind, loose = "double", F.regexp_replace(text, "_", "").try_cast("double")
    elif field in WHOLE_FIELDS or field == "took":
        kind, loose = "bigint", _whole_text(value)
    elif field in EDGE_FLAG_FIELDS:
        kind, loose = "boolean", F.lower(text).isin(*_TRUE_TEXT)
    else:
        return _as(value, "string")
    return F.when(value.isNotNull(), F.coalesce(_as(value, kind), loose))


def contract_payload(payload: Column, results: Column) -> Column:
    """The whole payload as a struct of exactly the contract fields."""
    def field_of(document: Column, field: str) -> Column:
        return F.try_variant_get(document, f"$.{field}", "variant")

    # Fields are looked up first and read second, so an absent one costs one lookup.
    found = F.transform(results, lambda result: F.struct(
        *[field_of(result, field).alias(field) for field in CONTRACT_FIELDS]))
    read = F.transform(found, lambda values: F.struct(
        *[_read(values[field], field).alias(field) for field in CONTRACT_FIELDS]))
    return F.struct(
        read.alias("results"),
        _read(field_of(payload, "requestedAt"), "requestedAt").alias("requestedAt"),
        _read(field_of(payload, "took"), "took").alias("took"),
    )
