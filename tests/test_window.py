"""Report window arithmetic."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quotelake.plans.window import ReportWindow, describe_window, session_windows

UTC = timezone.utc


def test_default_session():
    window = ReportWindow.session("2026-10-02")
    assert window.start == datetime(2026, 10, 2, 12, 45, tzinfo=UTC)
    assert window.end == datetime(2026, 10, 2, 21, 0, tzinfo=UTC)
    assert window.expected_cycles == 99


def test_cycles_round_up():
    assert ReportWindow.session("2026-10-02", "10:00", "10:27").expected_cycles == 6


@pytest.mark.parametrize("arguments", [
    ("02/10/2026",), ("2026-13-01",), ("2026-10-02", "9.45"), ("2026-10-02", "09:45", "29:00"),
    ("2026-10-02", "18:00", "09:45"), ("2026-10-02", "10:00", "10:00"),
])
def test_bad_windows(arguments):
    with pytest.raises(ValueError):
        ReportWindow.session(*arguments)


def test_half_open(spark):
    window = ReportWindow.utc("2024-01-01T00:00:00", "2024-01-01T01:00:00")
    times = spark.createDataFrame(
        [("2024-01-01 00:00:00",), ("2024-01-01 00:59:59.999999",), ("2024-01-01 01:00:00",),
         ("2023-12-31 23:59:59",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert window.apply(times, "t").count() == 2


def test_window_row_and_session_rows_agree(spark):
    times = spark.createDataFrame([("2024-01-02 02:00:00",)], "t string").select(
        F.col("t").cast("timestamp").alias("kafka_time"))
    by_day = session_windows(times, 15).collect()
    single = describe_window(times, ReportWindow.session("2024-01-01"), 15).collect()
    assert by_day == single
