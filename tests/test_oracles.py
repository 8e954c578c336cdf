"""Every registered query against its SQL on the smallest tables."""

import __spark_entry__ as entry_points
import compare
import oracles
import pytest
from conftest import SMALL
from quotelake.plans import registry

QUERIES, SQL = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


def test_each_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, SMALL), duck, SQL[name]) == []


def test_entry_returns_windows(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[:3] == ["window_start", "window_end", "symbol"]
    assert frame.count() > 0


def test_changed_source_gets_its_own_tables(spark, tmp_path):
    """A source folder that is written again is not answered from older tables."""
    folder = tmp_path / "source"
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.filter("event_id < 500").write.parquet(f"{folder}/events.parquet")
    first = QUERIES["report_01_overview"](spark, str(folder)).collect()
    events.write.mode("overwrite").parquet(f"{folder}/events.parquet")
    second = QUERIES["report_01_overview"](spark, str(folder)).collect()
    whole = QUERIES["report_01_overview"](spark, SMALL).collect()
    assert first != second == whole
