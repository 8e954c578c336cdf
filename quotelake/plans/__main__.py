"""Exports the report of one session: ``python -m quotelake.plans 2026-10-02 --root … --out …``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quotelake.plans.report import export_report
from quotelake.plans.window import SESSION_END, SESSION_START
from quotelake.schema import DEFAULT_TICKERS
from quotelake.session import configure
from quotelake.sources.lake import register_tables

if __name__ == "__main__":
    parser = argparse.ArgumentParser(prog="quotelake.plans")
    parser.add_argument("day", nargs="?", help="local date, YYYY-MM-DD; today if left out")
    parser.add_argument("start", nargs="?", default=SESSION_START, help="local time, HH:MM")
    parser.add_argument("end", nargs="?", default=SESSION_END, help="local time, HH:MM")
    parser.add_argument("--root", help="register the tables under this folder first")
    parser.add_argument("--out", required=True)
    parser.add_argument("--format", default="parquet", help="format of the lake tables")
    parser.add_argument("--out-format", default="csv", help="format of the sections")
    parser.add_argument("--tickers", nargs="+", default=list(DEFAULT_TICKERS))
    given = parser.parse_args()
    session = configure(SparkSession.builder.appName("quotelake-report").getOrCreate())
    if given.root:
        register_tables(session, given.root, given.format)
    for title in export_report(session, given.day, given.out, start=given.start, end=given.end,
                               fmt=given.out_format, tickers=given.tickers):
        print(title)
