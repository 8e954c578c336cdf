"""Spark result against DuckDB result: columns, type families, rows in any order."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb

FAMILIES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, datetime.datetime) and value.tzinfo:
        raise AssertionError("zoned timestamp in a result")
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def differences(spark_df, connection, sql) -> list[str]:
    """What differs; empty when both sides agree exactly."""
    relation = connection.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    found = []
    for field in spark_df.schema:
        expected = FAMILIES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types.get(field.name) != expected:
            found.append(f"type of {field.name}: {expected} against {types.get(field.name)}")
    left = _table(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    right = _table(relation.columns, relation.fetchall())
    if left[0] != right[0]:
        return found + [f"columns {left[0]} against {right[0]}"]
    if len(left[1]) != len(right[1]):
        found.append(f"{len(left[1])} rows against {len(right[1])}")
    unequal = [pair for pair in zip(left[1], right[1]) if pair[0] != pair[1]]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found
