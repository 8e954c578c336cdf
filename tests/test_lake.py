"""Layout guard, registration, report export."""

import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from quotelake.plans import registry
from quotelake.plans.report import export_report
from quotelake.sources import lake
from quotelake.streaming.sinks import ensure_table
from quotelake.sources import layout
from quotelake.sources.layout import (
    LayoutMismatch, Place, known_layout, layout_differences, planned_layout, require_layout, stored_file_layout,
    stored_layout,
)

BASE = {"symbol": Place("string", 1), "price": Place("double"), "day": Place("string", 2)}


@pytest.mark.parametrize("change, found", [
    ({}, []),
    ({"price": Place("float")}, [("price", "double", "float")]),
    ({"price": Place("double", 3)}, [("price", "double", "partition 3")]),
    ({"symbol": Place("string", 2), "day": Place("string", 1)},
     [("day", "partition 2", "partition 1"), ("symbol", "partition 1", "partition 2")]),
    ({"day": Place("date", 2)}, []),
    ({"more": Place("int")}, [("more", None, "int")]),
])
def test_one_difference_per_column(change, found):
    assert layout_differences(BASE, {**BASE, **change}) == found
    assert layout_differences({**BASE, **change}, BASE) == [(c, b, a) for c, a, b in found]


def test_guard_on_files(spark, root):
    planned = spark.createDataFrame([], lake.ddl(lake.SILVER.columns))
    require_layout(spark, root, lake.SILVER, planned)
    place = lake.location(root, lake.SILVER)
    rows = planned.sparkSession.range(3).selectExpr("CAST(id AS string) symbol", "'2024-01-01' trade_date",
                                                    "timestamp '2024-01-01' kafka_time")
    full = planned.unionByName(rows, allowMissingColumns=True)
    lake.write_table(full, root, lake.SILVER)
    require_layout(spark, root, lake.SILVER, planned)
    for wrong in (full.withColumn("price", full.price.cast("string")), full.withColumn("other", full.price)):
        with pytest.raises(LayoutMismatch, match="another layout"):
            require_layout(spark, root, lake.SILVER, wrong.drop("price") if "other" in wrong.columns else wrong)
    assert known_layout(spark, root, lake.SILVER)[0] == stored_file_layout(spark, root, lake.SILVER)
    # One file elsewhere among many is enough.
    full.limit(1).write.parquet(f"{place}/extra=1")
    with pytest.raises(LayoutMismatch, match="one table|several partitionings"):
        require_layout(spark, root, lake.SILVER, planned)


def test_registration_is_idempotent_and_export_needs_it(spark, tmp_path):
    root = registry.lake_root(spark, SMALL)
    out = str(tmp_path / "report")
    with pytest.raises(LookupError, match="exp_silver.quotes_rejected"):
        export_report(spark, "2024-01-05", out, prefix="exp_")
    for _ in range(2):
        names = lake.register_tables(spark, root, prefix="exp_")
    assert len(names) == 5 and lake.missing_tables(spark, "exp_") == []
    assert layout_differences(stored_layout(spark, "exp_silver.quotes"), planned_layout(lake.SILVER)) == []
    titles = export_report(spark, "2024-01-05", out, prefix="exp_", tickers=["CLICK", "NONE"])
    assert len(titles) == len(os.listdir(out)) == 19
    coverage = spark.read.parquet(f"{out}/14_coverage").collect()
    assert {r.symbol: r.expected_cycles for r in coverage} == {"CLICK": 99, "NONE": 99}
    total = {r.layer: r["rows"] for r in spark.read.parquet(f"{out}/01_overview").collect()}
    window = spark.read.parquet(f"{out}/00_window").first()
    stored = spark.table("exp_silver.quotes")
    assert total["Silver"] == stored.filter(
        (stored.kafka_time >= window.start_utc) & (stored.kafka_time < window.end_utc)).count() > 0


def test_export_sees_days_written_after_the_registration_and_names_its_columns(spark, root, tmp_path):
    def add(day):
        row = spark.range(1).selectExpr(
            "'A' symbol", "2D price", f"timestamp '{day} 15:00:00' kafka_time", f"'{day}' trade_date",
            f"timestamp '{day} 15:00:00' quote_time", f"timestamp '{day} 15:00:09' ingest_time",
            f"timestamp '{day} 15:00:11' silver_time")
        whole = spark.createDataFrame([], lake.ddl(lake.SILVER.columns)).unionByName(row, allowMissingColumns=True)
        lake.write_table(whole, root, lake.SILVER)

    for spec in lake.TABLES:
        ensure_table(spark, root, spec)
    add("2024-03-04")
    lake.register_tables(spark, root, prefix="new_")
    add("2024-03-05")
    out = str(tmp_path / "report")
    export_report(spark, "2024-03-05", out, prefix="new_", fmt="csv", tickers=["A"])
    rows = {r.layer: r["rows"] for r in spark.read.csv(f"{out}/01_overview", header=True).collect()}
    assert rows["Silver"] == "1"
    prices = spark.read.csv(f"{out}/03_prices_by_symbol", header=True)
    assert prices.columns == ["report_window", "symbol", "samples", "avg_price", "min_price", "max_price",
                              "price_spread"]
    assert prices.first().report_window.startswith("2024-03-05 09:45 to 2024-03-05 18:00")


def test_an_existing_table_is_left_alone(spark, root):
    for _ in range(2):
        ensure_table(spark, root, lake.SILVER)
        files = sorted(os.listdir(lake.location(root, lake.SILVER)))
        before = locals().get("before", files)
        assert files == before


def test_partition_values_stay_text(spark, root):
    frame = spark.range(1).selectExpr("'007' symbol", "'2024-01-01' trade_date", "timestamp '2024-01-01' kafka_time")
    for column in lake.SILVER.columns:
        if column not in frame.columns:
            frame = frame.selectExpr("*", f"CAST(NULL AS {lake.ddl([column]).split()[1]}) AS {column}")
    lake.write_table(frame, root, lake.SILVER)
    assert lake.read_table(spark, root, lake.SILVER).select("symbol", "trade_date").collect() == [
        ("007", "2024-01-01")]


def test_build_can_be_run_again(spark, root):
    from quotelake.plans.build import build_lake
    from quotelake.sources import from_events as source

    messages = source.quote_messages(source.read_events(spark, SMALL))
    counts = []
    for _ in range(2):
        tables = build_lake(spark, messages, root, bronze_clock=source.ingest_clock())
        counts.append([tables.bronze.count(), tables.silver.count(), tables.quarantine.count(),
                       tables.gold_operational.count(), tables.gold_financial.count()])
    assert counts[0] == counts[1] and all(counts[0])


def scanned(frame):
    """Rows that the scan of a plan has put out, after it ran."""
    execution = frame._jdf.queryExecution()
    frame._jdf.collectAsList()
    return execution.executedPlan().collectLeaves().apply(0).metrics().get("numOutputRows").get().value()


def test_files_follow_bytes_and_a_symbol_is_looked_up(spark, root):
    """Many symbols make no files of their own; a filter on one skips row groups, and a Bloom filter
    skips those that only might hold it."""
    import glob

    filler = spark.createDataFrame([], lake.ddl(lake.SILVER.columns))
    rows = spark.range(0, 40000, 1, 8).selectExpr(
        "concat('S', lpad(cast(pmod(id * 7919, 2000) * 2 AS string), 5, '0')) symbol",
        "cast(id AS double) price", "sha2(cast(id AS string), 512) long_name",
        "timestamp_seconds(1704190000 + id % 7200) kafka_time", "'2024-01-02' trade_date")
    whole = filler.unionByName(rows, allowMissingColumns=True)
    spark.conf.set("parquet.block.size", str(1 << 20))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        lake.write_table(whole, root, lake.SILVER)
        assert len(glob.glob(f"{lake.location(root, lake.SILVER)}/kafka_date=2024-01-02/*.parquet")) == 1
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        silver = lake.read_table(spark, root, lake.SILVER).select("symbol", "price")
        one = silver.filter("symbol = 'S00400'")
        assert one.count() == 20 and scanned(one) < 20000
        # Odd numbers lie between the bounds of some row group, and in none.
        assert [scanned(silver.filter(f"symbol = 'S{odd:05d}'")) for odd in (401, 1999, 3001)] == [0, 0, 0]
        # Bounds of time are kept narrow as well.
        late = lake.read_table(spark, root, lake.SILVER).filter("kafka_time >= timestamp_seconds(1704190000 + 7000)")
        assert late.count() == 40000 // 7200 * 200 + max(0, 40000 % 7200 - 7000) and scanned(late.select("price")) < 30000
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_guard_reads_no_footer_of_old_files(spark, root, monkeypatch):
    """A fingerprint answers for files it has seen; a foreign one among the new files is found."""
    import glob

    planned = spark.createDataFrame([], lake.ddl(lake.SILVER.columns))
    row = planned.unionByName(spark.range(1).selectExpr("'A' symbol", "timestamp '2024-01-01' kafka_time"),
                              allowMissingColumns=True)
    for _ in range(2):
        lake.write_table(row, root, lake.SILVER)
    require_layout(spark, root, lake.SILVER, planned)
    place = lake.location(root, lake.SILVER)
    # Files from before the fingerprint are not opened any more, not even these broken ones.
    upto = known_layout(spark, root, lake.SILVER)[1]
    for name in glob.glob(f"{place}/kafka_date=*/*.parquet"):
        os.truncate(name, 10)
        os.utime(name, (upto / 1000 - 2 * layout.OVERLAP / 1000,) * 2)
    require_layout(spark, root, lake.SILVER, planned)
    lake.write_table(row, root, lake.SILVER)
    require_layout(spark, root, lake.SILVER, planned)
    assert known_layout(spark, root, lake.SILVER)[1] > upto
    spark.range(1).selectExpr("id AS price").write.mode("append").parquet(f"{place}/kafka_date=2024-01-02")
    for _ in range(2):
        with pytest.raises(LayoutMismatch, match="one table|several layouts"):
            require_layout(spark, root, lake.SILVER, planned)


def test_the_archive_holds_the_package(tmp_path):
    import subprocess
    import sys
    import zipfile

    from quotelake.package import archive

    place = archive(str(tmp_path / "q.zip"))
    assert {"quotelake/schema.py", "quotelake/streaming/__main__.py"} <= set(zipfile.ZipFile(place).namelist())
    code = "import quotelake.schema as s; print(s.__file__)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": place, "PATH": os.environ["PATH"]},
                         capture_output=True, text=True, check=True).stdout
    assert out.startswith(place)


def test_events_are_dealt_out_before_they_grow_into_documents(spark, tmp_path, monkeypatch):
    """One file of one row group is one task as it is stored."""
    from quotelake.sources import from_events as source

    monkeypatch.setattr(source, "EVENTS_PER_TASK", 100)
    stored = spark.read.parquet(f"{SMALL}/events.parquet").coalesce(1)
    stored.write.parquet(f"{tmp_path}/events.parquet")
    assert spark.read.parquet(f"{tmp_path}/events.parquet").rdd.getNumPartitions() == 1
    events = source.read_events(spark, str(tmp_path))
    sizes = [row["n"] for row in events.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == stored.count() and max(sizes) <= 160
    assert sorted(r.event_id for r in events.collect()) == sorted(r.event_id for r in stored.collect())


def test_a_task_reads_a_bounded_share_of_stored_documents(spark, tmp_path):
    """Stored documents unpack to many times their bytes, so the bytes of a split are few."""
    spark.range(0, 120_000, 1, 8).selectExpr("concat(sha2(cast(id AS string), 512), sha2(cast(-id AS string), 512)) value") \
        .coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(f"{tmp_path}/messages")
    tasks = spark.read.parquet(f"{tmp_path}/messages").rdd.getNumPartitions()
    size = sum(os.path.getsize(f"{tmp_path}/messages/{name}") for name in os.listdir(f"{tmp_path}/messages"))
    assert size > 15 << 20 and tasks >= 3
    assert int(spark.conf.get("spark.sql.files.maxPartitionBytes").removesuffix("m")) == 16
