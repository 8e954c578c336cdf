"""The jobs as streams: late rows, Gold modes, restarts, agreement with batch."""

from datetime import datetime, timedelta, timezone

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from quotelake.operators.bronze import to_bronze
from quotelake.operators.gold import to_gold_financial, to_gold_operational
from quotelake.operators.quarantine import to_quarantine
from quotelake.operators.silver import to_silver
from quotelake.schema import QUOTE_FIELDS, ddl
from quotelake.sources import from_events as source
from quotelake.sources import lake, snapshots
from quotelake.sources.kafka import message_files_stream
from quotelake.operators import logs, measures, partials
from quotelake.streaming import committed, jobs, sinks
from quotelake.streaming import partials as kept_partials
from quotelake.streaming.sinks import ALL_AVAILABLE, batch_progress, gold_stream

UTC = timezone.utc
NOW = datetime(2024, 1, 2, tzinfo=UTC)
BARE = "kafka_time timestamp, ingest_time timestamp, " + ddl(QUOTE_FIELDS)

# Three batches of (symbol, price, time), 15 minutes of watermark between them.
BATCHES = [
    [("A", 1.0, "10:00:00"), ("A", 1.0, "10:00:00"), ("A", 2.0, "10:00:00"), ("B", 1.0, "10:01:00")],
    [("A", 1.0, "10:00:00"), ("C", 1.0, "09:50:00"), ("Z", None, "2030")],
    [("D", 1.0, "09:00:00"), ("D", 2.0, "09:46:00"), ("D", 3.0, "09:45:59")],
]


def stamp(text):
    return "2030-01-01T00:00:00Z" if text == "2030" else f"2024-01-01T{text}Z"


def write_batches(spark, folder, batches):
    """One file per batch; later batches get later file times, which set their order."""
    import os
    for place, batch in enumerate(batches):
        rows = []
        for symbol, price, text in batch:
            values = dict.fromkeys(QUOTE_FIELDS)
            values |= {"symbol": symbol, "regularMarketPrice": price,
                       "regularMarketTime": stamp(text)}
            rows.append((NOW, NOW, *values.values()))
        target = f"{folder}/b{place}"
        spark.createDataFrame(rows, BARE).coalesce(1).write.parquet(target)
        for name in os.listdir(target):
            os.utime(f"{target}/{name}", (1_700_000_000 + place * 100,) * 2)


def bronze_stream(spark, folder):
    return (spark.readStream.schema(BARE).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(folder))


def finish(writer, checkpoint, target):
    query = (writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .start(target))
    query.awaitTermination()
    return query


@pytest.mark.parametrize("lanes", [None, 4])
def test_late_rows_are_dropped_and_counted(spark, tmp_path, lanes):
    folder = str(tmp_path / "in")
    write_batches(spark, folder, BATCHES)
    silver = to_silver(bronze_stream(spark, folder), lanes=lanes)
    query = finish(silver.writeStream.format("parquet"), str(tmp_path / "cp"),
                   str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.symbol, r.price) for r in rows) == [
        ("A", 1.0), ("A", 2.0), ("B", 1.0), ("C", 1.0)]
    assert sum(p["dropped_rows"] for p in batch_progress(query)) == 3
    marks = [p["watermark"] for p in batch_progress(query) if p["watermark"]]
    assert max(marks).startswith("2024-01-01T09:46")


def silver_stream(spark, tmp_path, batches):
    folder = str(tmp_path / "in")
    write_batches(spark, folder, batches)
    return bronze_stream(spark, folder).select(
        "symbol", F.col("regularMarketPrice").alias("price"),
        F.col("regularMarketTime").cast("timestamp").alias("quote_time"))


@pytest.mark.parametrize("mode, late_windows", [("complete", 2), ("update", 0), ("append", 0)])
def test_gold_modes_and_late_rows(spark, tmp_path, root, mode, late_windows):
    """Complete mode counts late rows, the other modes let their state go."""
    # A row is late by the watermark that the batch before had, hence the middle batch.
    ticks = silver_stream(spark, tmp_path, [BATCHES[0], [("B", 1.0, "10:01:30")], BATCHES[2]])
    query = gold_stream(to_gold_financial(ticks), root, lake.GOLD_FINANCIAL, f"gold_{mode}",
                        str(tmp_path / "cp"), mode, ALL_AVAILABLE)
    query.awaitTermination()
    rows = lake.read_table(spark, root, lake.GOLD_FINANCIAL).collect()
    late = {(r.window_start.hour, r.window_start.minute): r.samples
            for r in rows if r.symbol == "D"}
    assert len(late) == late_windows
    if mode == "complete":
        assert late == {(9, 0): 1, (9, 45): 2}
    if mode != "append":
        on_time = {r.symbol: r.samples for r in rows if r.symbol != "D"}
        assert on_time == {"A": 3, "B": 2}


def test_update_keeps_other_windows_of_the_day(spark, tmp_path, root):
    batches = [[("A", 1.0, "10:00:00"), ("A", 9.0, "10:20:00")],
               [("A", 3.0, "10:21:00"), ("B", 5.0, "10:22:00")]]
    ticks = silver_stream(spark, tmp_path, batches)
    gold_stream(to_gold_financial(ticks), root, lake.GOLD_FINANCIAL, "upsert",
                str(tmp_path / "cp"), "update", ALL_AVAILABLE).awaitTermination()
    rows = lake.read_table(spark, root, lake.GOLD_FINANCIAL).collect()
    assert sorted((r.symbol, r.window_start.minute, r.samples, r.avg_price) for r in rows) == [
        ("A", 0, 1, 1.0), ("A", 20, 2, 6.0), ("B", 20, 1, 5.0)]


def test_unknown_gold_mode_is_refused(spark, tmp_path, root):
    with pytest.raises(ValueError, match="mode must be one of"):
        gold_stream(spark.range(1), root, lake.GOLD_FINANCIAL, "x", str(tmp_path), "merge")


def flow_for(spark, root):
    clocks = jobs.Clocks(source.ingest_clock(), source.silver_clock(), source.gold_clock())
    return jobs.Flow(spark, root, f"{root}/checkpoints", clocks=clocks)


def as_set(frame):
    return sorted(map(repr, frame.collect()))


def test_all_jobs_agree_with_batch_and_a_rerun_adds_nothing(spark, root):
    messages = source.quote_messages(source.read_events(spark, SMALL))
    messages.write.parquet(f"{root}/messages")
    flow = flow_for(spark, root)
    feed = message_files_stream(spark, f"{root}/messages")
    jobs.catch_up(flow, feed)
    tables = lake.open_lake(spark, root)
    bronze = to_bronze(spark.read.parquet(f"{root}/messages"), source.ingest_clock())
    silver = to_silver(bronze, clock=source.silver_clock())
    same = ["symbol", "quote_time", "price", "volume", "trade_date"]
    assert as_set(tables.bronze.drop("kafka_date")) == as_set(bronze)
    assert as_set(tables.quarantine.drop("kafka_date")) == as_set(to_quarantine(bronze))
    assert as_set(tables.silver.select(same)) == as_set(silver.select(same))
    stored = tables.silver
    for found, expected in ((tables.gold_operational, to_gold_operational(stored)),
                            (tables.gold_financial, to_gold_financial(stored))):
        shown = ["window_start", "window_end", "symbol", "min_price", "max_price", "samples"]
        assert as_set(found.select(shown)) == as_set(expected.select(shown))
    before = {spec.path: lake.read_table(spark, root, spec).count() for spec in lake.TABLES}
    jobs.catch_up(flow, feed)
    after = {spec.path: lake.read_table(spark, root, spec).count() for spec in lake.TABLES}
    assert before == after


def test_jobs_refuse_a_table_of_another_layout(spark, root):
    spark.range(1).selectExpr("id AS other").write.parquet(lake.location(root, lake.QUARANTINE))
    flow = jobs.Flow(spark, root, f"{root}/checkpoints", checks=f"{root}/checks")
    with pytest.raises(RuntimeError, match="another layout"):
        jobs.start_quarantine(flow, ALL_AVAILABLE)
    jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    entries = logs.by_topic(logs.parse_log_lines(spark.read.text(f"{root}/checks")))
    assert [(r.message, r.level, r.log_topic) for r in entries.collect()] == [
        (lake.QUARANTINE.path, "ERROR", "layout_checks")]


def test_late_start_of_an_upstream_table(spark, root):
    """A downstream job may start before its upstream has written anything."""
    flow = flow_for(spark, root)
    jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    assert lake.read_table(spark, root, lake.SILVER).count() == 0
    message = [(NOW - timedelta(minutes=1),
                '{"results":[{"symbol":"A","regularMarketPrice":1,'
                '"regularMarketTime":"2024-01-01T10:00:00Z"}]}')]
    spark.createDataFrame(message, "timestamp timestamp, value string").selectExpr(
        "'t' AS topic", "0 AS partition", "1L AS offset", "'A' AS key", "timestamp", "value"
    ).write.parquet(f"{root}/messages")
    jobs.drain(lambda: jobs.start_bronze(
        flow, message_files_stream(spark, f"{root}/messages"), ALL_AVAILABLE))
    jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    assert [r.symbol for r in lake.read_table(spark, root, lake.SILVER).collect()] == ["A"]


def test_gate_feeds_bronze_as_a_stream(spark, root):
    """Responses are gated, published as files and parsed, all as streams."""
    from quotelake.operators import edge

    good = '{"results":[{"symbol":"PETR4","data":{"regularMarketPrice":"7.5"}}]}'
    spark.createDataFrame(
        [(" petr4 ", good), ("PETR4", "{"), ("no", good)], "ticker string, body string"
    ).write.parquet(f"{root}/responses")
    responses = spark.readStream.schema("ticker string, body string").parquet(f"{root}/responses")
    sent = edge.publishable(edge.gate(responses)).selectExpr(
        "'quotes' AS topic", "0 AS partition", "0L AS offset", "key",
        "current_timestamp() AS timestamp", "value")
    finish(sent.writeStream.format("parquet"), f"{root}/cp", f"{root}/messages")
    flow = flow_for(spark, root)
    jobs.drain(lambda: jobs.start_bronze(
        flow, message_files_stream(spark, f"{root}/messages"), ALL_AVAILABLE))
    row, = lake.read_table(spark, root, lake.BRONZE).collect()
    assert (row.key, row.symbol, row.regularMarketPrice, row.parse_status) == (
        "PETR4", "PETR4", 7.5, "parse_ok")


def test_files_per_partition_and_trigger_are_bounded(spark, root):
    import glob

    source.quote_messages(source.read_events(spark, SMALL)).write.parquet(f"{root}/messages")
    flow = jobs.Flow(spark, root, f"{root}/checkpoints", writers=1)
    jobs.drain(lambda: jobs.start_bronze(
        flow, message_files_stream(spark, f"{root}/messages"), ALL_AVAILABLE))
    jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    for table in ("bronze", "silver"):
        folders = glob.glob(f"{root}/{table}/quotes/kafka_date=*")
        files = glob.glob(f"{root}/{table}/quotes/kafka_date=*/*.parquet")
        assert len(folders) > 20 and len(files) == len(folders)


def test_a_hot_day_is_written_by_as_many_tasks_as_its_rows_ask_for(spark, root):
    """A live trigger, whose rows are all of one day: its files follow its bytes."""
    import glob

    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 60000, 1, 12).selectExpr(
        "'t' topic", "0 partition", "id offset", "'A' key", "timestamp_seconds(1704190000 + id % 50000) timestamp",
        "sha2(cast(id AS string), 512) value")
    rows.write.parquet(f"{root}/messages")
    counts = []
    for place, bytes_ in (("large", "64m"), ("small", "512k")):
        spark.conf.set(size, bytes_)
        flow = jobs.Flow(spark, f"{root}/{place}", f"{root}/{place}/checkpoints")
        jobs.drain(lambda: jobs.start_bronze(flow, message_files_stream(spark, f"{root}/messages"), ALL_AVAILABLE))
        counts.append(len(glob.glob(f"{root}/{place}/bronze/quotes/kafka_date=2024-01-02/*.parquet")))
    spark.conf.unset(size)
    assert counts[0] == 1 and counts[1] >= 4


def windows(spark, *rows):
    return to_gold_financial(spark.createDataFrame(
        [(s, p, datetime(2024, 1, day, 10, minute, tzinfo=UTC)) for s, p, day, minute in rows],
        "symbol string, price double, quote_time timestamp"))


def stored_windows(spark, root):
    frame = lake.read_table(spark, root, lake.GOLD_FINANCIAL)
    return sorted((r.symbol, r.window_start, r.samples, r.avg_price) for r in frame.collect())


def put(spark, root, rows, batch, mode="update", writer="w", registered=None):
    sinks.write_gold(windows(spark, *rows), batch, root, lake.GOLD_FINANCIAL, mode, writer, registered)


def manifest(spark, root):
    return snapshots.latest(spark, lake.location(root, lake.GOLD_FINANCIAL))


@pytest.mark.parametrize("mode", ["complete", "update"])
def test_a_repeated_batch_leaves_the_same_gold(spark, root, mode):
    """After a crash between the write and the checkpoint, the batch comes again."""
    sinks.ensure_table(spark, root, lake.GOLD_FINANCIAL)
    rows = (("A", 1.0, 1, 0), ("B", 2.0, 1, 0), ("A", 3.0, 2, 0))
    put(spark, root, rows, 0, mode)
    first, version = stored_windows(spark, root), manifest(spark, root).version
    put(spark, root, rows, 0, mode)
    assert stored_windows(spark, root) == first and len(first) == 3
    more = (*rows, ("A", 5.0, 1, 1))
    for _ in range(2):
        put(spark, root, more if mode == "complete" else more[::3], 1, mode)
    assert [row[2:] for row in stored_windows(spark, root)] == [(2, 3.0), (1, 3.0), (1, 2.0)]
    now = manifest(spark, root)
    assert now.version == version + 1 and (now.writer, now.batch) == ("w", 1)
    # The second day was not written again.
    assert now.days["2024-01-02"].snapshot < now.days["2024-01-01"].snapshot
    assert lake.stored_rows(spark, root, lake.GOLD_FINANCIAL).count() == 3


def test_a_crash_while_gold_is_written_changes_nothing(spark, root):
    """Files without a manifest are not read, whatever part of them is there."""
    sinks.ensure_table(spark, root, lake.GOLD_FINANCIAL)
    put(spark, root, (("A", 1.0, 1, 0), ("B", 2.0, 2, 0)), 0)
    first, before = stored_windows(spark, root), manifest(spark, root)
    batch = (("A", 1.0, 1, 0), ("A", 3.0, 1, 1), ("B", 4.0, 2, 0))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(snapshots.files, "create_text", lambda *_: False)
        with pytest.raises(RuntimeError, match="written by another job"):
            put(spark, root, batch, 1)
    assert stored_windows(spark, root) == first and manifest(spark, root) == before
    put(spark, root, batch, 1)
    assert [row[2:] for row in stored_windows(spark, root)] == [(2, 2.0), (1, 4.0)]


def test_versions_ask_no_clock(spark, root, monkeypatch):
    """A machine whose clock is behind still replaces what another has written."""
    import time

    sinks.ensure_table(spark, root, lake.GOLD_FINANCIAL)
    put(spark, root, (("A", 1.0, 1, 0),), 0)
    for name in ("time", "time_ns"):
        monkeypatch.setattr(time, name, lambda: 0)
    put(spark, root, (("A", 7.0, 1, 0),), 1)
    assert [row[2:] for row in stored_windows(spark, root)] == [(1, 7.0)]


def test_a_new_checkpoint_starts_over(spark, root):
    """Batch ids of another query do not count."""
    sinks.ensure_table(spark, root, lake.GOLD_FINANCIAL)
    put(spark, root, (("A", 1.0, 1, 0),), 5)
    put(spark, root, (("A", 2.0, 1, 0), ("A", 2.0, 3, 0)), 0, "complete", "other")
    assert [row[2:] for row in stored_windows(spark, root)] == [(1, 2.0), (1, 2.0)]
    # A complete result is the table: days that it lacks go.
    put(spark, root, (("A", 2.0, 3, 0),), 1, "complete", "other")
    assert len(stored_windows(spark, root)) == 1


def test_only_changed_days_are_written(spark, root):
    sinks.ensure_table(spark, root, lake.GOLD_FINANCIAL)
    rows = [("A", 1.0, day, 0) for day in range(1, 10)]
    put(spark, root, rows, 0, "complete")
    changed = lake.placed(windows(spark, *rows, ("A", 3.0, 4, 1), ("B", 1.0, 7, 0)), lake.GOLD_FINANCIAL)
    place = lake.location(root, lake.GOLD_FINANCIAL)
    found, stay = sinks.gold_days(changed, manifest(spark, root), place, "complete")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "IN (2024-01-04,2024-01-07)" in plan.replace(" IN (", "IN (") and "Join" not in plan
    assert len(stay) == 7
    # An update opens the snapshots of its own days only.
    part = lake.placed(windows(spark, ("B", 1.0, 7, 0)), lake.GOLD_FINANCIAL)
    found, stay = sinks.gold_days(part, manifest(spark, root), place, "update")
    assert {name.split("window_date=")[1][:10] for name in found.inputFiles()} == {"2024-01-07"}
    same, _ = sinks.gold_days(lake.placed(windows(spark, *rows), lake.GOLD_FINANCIAL), manifest(spark, root), place,
                              "complete")
    assert same is None


def test_registered_gold_is_current_and_vacuum_removes_the_rest(spark, root):
    import glob

    for spec in lake.TABLES:
        sinks.ensure_table(spark, root, spec)
    lake.register_tables(spark, root, prefix="cur_")
    stale = lake.read_table(spark, root, lake.GOLD_FINANCIAL)
    for batch, price in enumerate((1.0, 2.0, 3.0)):
        put(spark, root, (("A", price, 1, 0), ("A", price, 1 + batch, 0)), batch, "complete", registered="cur_")
        table = spark.table("cur_gold.prices_by_quote_5min")
        assert sorted((r.window_date, r.avg_price) for r in table.collect()) == sorted({
            (f"2024-01-0{day}", price) for day in (1, 1 + batch)})
    place = lake.location(root, lake.GOLD_FINANCIAL)
    under_way = f"{place}/window_date=2024-01-01/v=000000000099-attempt"
    table.limit(1).drop("window_date").write.parquet(under_way)
    assert len(snapshots.vacuum(spark, place, keep=1)) == 3
    left = glob.glob(f"{place}/window_date=*/v=*")
    assert len(left) == 3 and under_way in left
    assert len(stored_windows(spark, root)) == 2 and stale.count() == 0
    assert lake.register_tables(spark, root, prefix="cur_") and table.count() == 2


def test_bounded_files_are_refused_in_front_of_a_watermark(spark, root):
    flow = jobs.Flow(spark, root, f"{root}/checkpoints", max_files_per_trigger=1)
    for start in (jobs.start_silver, jobs.start_gold_operational, jobs.start_gold_financial):
        with pytest.raises(ValueError, match="loses rows"):
            start(flow, ALL_AVAILABLE)
    jobs.drain(lambda: jobs.start_quarantine(flow, ALL_AVAILABLE))


def test_late_quotes_are_kept_once_and_every_batch_is_logged(spark, root):
    bronze = to_bronze(source.quote_messages(source.read_events(spark, SMALL)), source.ingest_clock())
    log = sinks.ProgressLog(spark, f"{root}/progress")
    spark.streams.addListener(log)
    flow = flow_for(spark, root)
    half = F.col("kafka_time") >= "2024-01-16"
    try:
        for part in (half, ~half):
            lake.write_table(bronze.filter(part), root, lake.BRONZE)
            jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20000)
        spark.streams.removeListener(log)
    whole = to_silver(bronze, clock=source.silver_clock())
    counts = [jobs.append_lost_quotes(flow).count() for _ in range(2)]
    stored = lake.read_table(spark, root, lake.SILVER)
    assert counts[0] == counts[1] > 0 and counts[0] + stored.count() == whole.count()
    assert lake.all_silver(spark, root).count() == whole.count()
    logged = spark.read.schema(sinks.PROGRESS).json(f"{root}/progress")
    # Two runs of Silver, at most an hour apart.
    assert len(logged.inputFiles()) <= 4
    assert logged.filter("query = 'silver'").agg(F.sum("dropped_rows")).first()[0] >= counts[0]


def bronze_rows(spark):
    return to_bronze(source.quote_messages(source.read_events(spark, SMALL)), source.ingest_clock())


def test_what_silver_has_yet_to_read_is_not_late(spark, root):
    """Bronze ahead of Silver, then both; a broken run of the late job is repeated."""
    bronze, flow = bronze_rows(spark), flow_for(spark, root)
    assert jobs.append_lost_quotes(flow).count() == 0
    later = F.col("kafka_time") >= "2024-01-16"
    lake.write_table(bronze.filter(later), root, lake.BRONZE)
    jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    lake.write_table(bronze.filter(~later), root, lake.BRONZE)
    assert jobs.append_lost_quotes(flow).count() == 0
    jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    with pytest.MonkeyPatch.context() as patch:
        def broken(*_):
            raise OSError("lost")
        patch.setattr(jobs.files, "create_text", broken)
        with pytest.raises(OSError, match="lost"):
            jobs.append_lost_quotes(flow)
    late = jobs.append_lost_quotes(flow)
    known = late.unionByName(lake.read_table(spark, root, lake.SILVER))
    keys = ["symbol", "quote_time", "price"]
    assert late.count() > 0 and known.count() == known.select(keys).distinct().count()
    assert known.count() == to_silver(bronze, clock=source.silver_clock()).count()


def test_the_late_job_opens_only_days_of_files_that_are_not_judged(spark, root):
    bronze, flow = bronze_rows(spark), flow_for(spark, root)
    for day in ("2024-01-05", "2024-01-06", "2024-01-07"):
        lake.write_table(bronze.filter(F.to_date("kafka_time") == day), root, lake.BRONZE)
        jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    assert committed.finished_entry(spark, flow.checkpoint("silver")) == 2
    rows = jobs.unjudged_bronze(flow, 0, 1)
    assert {str(r.day) for r in rows.select(F.to_date("kafka_time").alias("day")).distinct().collect()} == {"2024-01-06"}
    assert "PartitionFilters: [isnotnull(kafka_date" in plan_of(rows) and "2024-01-05" not in plan_of(rows)
    jobs.append_lost_quotes(flow)
    assert jobs.unjudged_bronze(flow, 2, 2).count() == 0


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def test_the_log_of_a_source_is_read_behind_its_compaction(spark, root):
    flow = flow_for(spark, root)
    with pytest.MonkeyPatch.context():
        spark.conf.set("spark.sql.streaming.fileSource.log.compactInterval", "2")
        for batch in range(5):
            lake.write_table(bronze_rows(spark).filter(F.col("offset") % 5 == batch), root, lake.BRONZE)
            jobs.drain(lambda: jobs.start_quarantine(flow, ALL_AVAILABLE))
        spark.conf.unset("spark.sql.streaming.fileSource.log.compactInterval")
    checkpoint = flow.checkpoint("quarantine")
    last = committed.finished_entry(spark, checkpoint)
    files = committed.read_files(spark, checkpoint, committed.NOTHING, last)
    assert last == 4 and files.count() == len(lake.stored_rows(spark, root, lake.BRONZE).inputFiles())
    assert {r.entry for r in committed.read_files(spark, checkpoint, 1, 3).collect()} == {2, 3}


def test_a_backlog_in_order_of_its_days_drops_nothing(spark, root):
    """The same files in any other order would lose rows; live operation goes on from there."""
    bronze, flow = bronze_rows(spark), flow_for(spark, root)
    early = F.col("kafka_time") < "2024-01-20"
    lake.write_table(bronze.filter(early), root, lake.BRONZE)
    assert jobs.backfill_silver(flow, 7) == 3
    assert jobs.backfill_silver(flow, 7) == 1
    lake.write_table(bronze.filter(~early), root, lake.BRONZE)
    jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    keys = ["symbol", "quote_time", "price", "trade_date"]
    assert as_set(lake.read_table(spark, root, lake.SILVER).select(keys)) == as_set(
        to_silver(bronze, clock=source.silver_clock()).select(keys))
    assert jobs.append_lost_quotes(flow).count() == 0


@pytest.mark.parametrize("survivor", ["seen", "earliest"])
def test_a_backfill_opens_its_state_for_one_batch_without_rows(spark, root, survivor):
    """A batch for each run, and one after the last; the setting of the session is back."""
    flow = jobs.Flow(spark, root, f"{root}/checkpoints", survivor=survivor,
                     clocks=jobs.Clocks(source.ingest_clock(), source.silver_clock()))
    bronze = bronze_rows(spark)
    lake.write_table(bronze, root, lake.BRONZE)
    runs = jobs.backfill_silver(flow, 16)
    assert runs == 2 and len(jobs.files.names(spark, f"{flow.checkpoint('silver')}/commits/*")) == runs + 1
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
    passed, whole = lake.read_table(spark, root, lake.SILVER), to_silver(bronze, clock=source.silver_clock())
    if survivor == "earliest":
        # The newest quotes are still held.
        whole = whole.filter(F.col("quote_time") <= passed.agg(F.max("quote_time")).first()[0])
    keys = ["symbol", "quote_time", "price"]
    assert as_set(passed.select(keys)) == as_set(whole.select(keys))


def test_unknown_survivor_is_refused(spark):
    with pytest.raises(ValueError, match="survivor must be one of"):
        to_silver(bronze_rows(spark), survivor="last")


def quotes(spark, *rows):
    """Silver rows of (symbol, price, day, minute)."""
    frame = spark.createDataFrame(
        [(s, p, datetime(2024, 1, day, 10, minute, tzinfo=UTC)) for s, p, day, minute in rows],
        "symbol string, price double, kafka_time timestamp")
    return frame.selectExpr(
        "*", "kafka_time AS quote_time", "CAST(NULL AS double) AS market_cap", "CAST(NULL AS double) AS change",
        "kafka_time + INTERVAL 30 SECONDS AS ingest_time", "kafka_time + INTERVAL 90 SECONDS AS silver_time")


def test_partials_add_up_once_and_open_only_their_days(spark, root):
    first = quotes(spark, ("A", 1.0, 1, 0), ("A", -1.0, 1, 1), ("B", 2.0, 2, 0))
    second = quotes(spark, ("A", 3.0, 2, 5), (None, 3.0, 2, 5))
    kept_partials.add_batch(first, 0, root, "w")
    days = snapshots.latest(spark, f"{root}/metrics/day_counts").days
    for _ in range(2):
        kept_partials.add_batch(second, 1, root, "w")
    kept = kept_partials.open_partials(spark, root)
    whole = first.unionByName(second)
    assert as_set(partials.quality_scores(kept)) == as_set(measures.quality_scores(whole))
    assert as_set(partials.latency_percentiles(kept)) == as_set(measures.latency_percentiles(whole))
    assert as_set(partials.ingest_latency_series(kept)) == as_set(measures.ingest_latency_series(whole))
    assert as_set(partials.silver_residue(kept)) == as_set(measures.silver_residue(whole, "silver_time"))
    now = snapshots.latest(spark, f"{root}/metrics/day_counts").days
    assert now["2024-01-01"] == days["2024-01-01"] and now["2024-01-02"] != days["2024-01-02"]
    kept_partials.add_batch(first.limit(0), 2, root, "w")
    none = kept_partials.open_partials(spark, f"{root}/none")
    assert as_set(partials.quality_scores(none)) == as_set(measures.quality_scores(first.limit(0)))
    assert kept_partials.vacuum_partials(spark, root, keep=1) == 3


def test_partials_count_late_quotes(spark, root):
    bronze, flow = bronze_rows(spark), flow_for(spark, root)
    later = F.col("kafka_time") >= "2024-01-16"
    for part in (later, ~later):
        lake.write_table(bronze.filter(part), root, lake.BRONZE)
        jobs.drain(lambda: jobs.start_silver(flow, ALL_AVAILABLE))
    jobs.drain(lambda: jobs.start_partials(flow, ALL_AVAILABLE))
    jobs.append_lost_quotes(flow)
    jobs.drain(lambda: jobs.start_partials(flow, ALL_AVAILABLE))
    found = partials.silver_residue(kept_partials.open_partials(spark, root)).first()
    assert found["rows"] == lake.all_silver(spark, root).count() == to_silver(bronze, clock=source.silver_clock()).count()
