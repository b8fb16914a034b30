"""Streams that keep stores: repeated batches, restarts, changes, keyed history, supervision, pruned look-ups."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldwatch.operators import classify, compliance, history, pump
from fieldwatch.sources import telemetry
from fieldwatch.streaming import stores, streams

T0 = 1704067200000
ROW = "k string, ts long, n long, v double, expires_at long"


@pytest.fixture(scope="module")
def wells(spark, sf_dir):
    return telemetry.wells(telemetry.events(spark, sf_dir), "mixed").cache()


def feed(spark, folder, wells, parts):
    """Well readings as files that a stream takes one by one, in the order given."""
    for rows in parts:
        rows.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(wells.schema).option("maxFilesPerTrigger", 1).parquet(folder).withColumn("event_timestamp", F.timestamp_millis("timestamp"))


def cut(wells, bounds):
    return [wells.filter(f"n >= {a} AND n < {b}") for a, b in zip(bounds, bounds[1:], strict=False)]


def tuples(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)



def test_a_batch_twice_is_a_batch_once_and_compaction_changes_nothing(spark, tmp_path):
    path, day = str(tmp_path / "store"), 86_400_000
    batches = [[("a", T0, 1, 1.0), ("b", T0 + 1, 2, 2.0)], [("a", T0 + day, 3, 3.0)], [("a", T0 + 5, 4, 4.0), ("c", T0 + 2 * day, 5, 5.0), (None, T0, 6, 6.0)], []]
    want = [(None, T0, 6, 6.0), ("a", T0 + day, 3, 3.0), ("b", T0 + 1, 2, 2.0), ("c", T0 + 2 * day, 5, 5.0)]
    keep = stores.sink(path, ROW, "k", ["ts", "n"], "ts", lambda batch: batch, every=2)
    for batch_id, rows in enumerate(batches):
        frame = spark.createDataFrame([(k, ts, n, v, ts + 1000) for k, ts, n, v in rows], ROW)
        keep(frame, batch_id)
        before = tuples(stores.log(spark, path, ROW), "k", "ts", "n")
        keep(frame, batch_id)
        assert tuples(stores.log(spark, path, ROW), "k", "ts", "n") == before
    got = stores.current(spark, path, ROW, "k", ["ts", "n"]).select("k", "ts", "n", "v").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert stores.snapshot(spark, path) == 3
    shutil.rmtree(f"{path}/latest/through=3")  # as if the last compaction had never been
    assert sorted(map(tuple, stores.current(spark, path, ROW, "k", ["ts", "n"]).select("k", "ts", "n", "v").collect()), key=repr) == sorted(want, key=repr)


def test_lookups_read_the_keys_bucket_and_the_dates_that_matter(spark, tmp_path):
    path, day = str(tmp_path / "store"), 86_400_000
    rows = [(f"k{i}", T0 + d * day, d, 1.0, T0 + d * day + 1000) for i in range(40) for d in range(5)]
    stores.upsert(spark.createDataFrame(rows, ROW), 0, path, "ts", "k")
    found = stores.lookup(spark, path, ROW, "k", "k7", ["ts", "n"], T0 + 4 * day + 500, 1000)
    assert tuples(found, "k", "ts") == [("k7", T0 + 4 * day)]
    assert stores.lookup(spark, path, ROW, "k", "k7", ["ts", "n"], T0 + 4 * day + 1000, 1000).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = stores.log(spark, path, ROW).filter((F.col("event_date") >= "2024-01-05") & (F.col("bucket") == stores.bucket_of(F.lit("k7"))))
    assert 0 < len(read.inputFiles()) and read.select("event_date", "bucket").distinct().count() == 1


def test_whole_dates_are_dropped_and_only_kept_ones_read(spark, tmp_path):
    path, day = str(tmp_path / "windows"), 86_400_000
    rows = [(f"F{i}", T0 + d * day, d, 1.0, 0) for i in range(3) for d in range(20)]
    stores.upsert(spark.createDataFrame(rows, ROW), 0, path, "ts", "k")
    gone = stores.drop_before(spark, f"{path}/log", "2024-01-14")
    assert gone == [f"event_date=2024-01-{d:02}" for d in range(1, 14)]
    left = stores.log(spark, path, ROW)
    assert left.count() == 21 and left.select("event_date").distinct().count() == 7
    assert stores.drop_before(spark, f"{path}/log", "2024-01-14") == []


def test_keyed_history_of_files_out_of_order_equals_the_table(spark, tmp_path, wells):
    """Within the delay files overlap in time; the state sorts them, caps them and forgets after an idle hour."""
    parts = [wells.filter(f"n >= {a} AND n < {a + 100} AND n % 2 = {k}") for a in range(0, 1000, 100) for k in (1, 0)]
    late = wells.withColumn("timestamp", F.col("timestamp") + F.when(F.col("n") >= 700, 3_700_000).otherwise(0))  # an idle hour at 700
    parts = [late.filter(f"n >= {a} AND n < {a + 8} AND n % 2 = {k}") for a in range(680, 720, 8) for k in (1, 0)] + [late.filter("n >= 720")]
    stream = feed(spark, str(tmp_path / "in"), late, parts)
    got = streams.run(streams.pump_history(stream, cap=5), "ordered")
    table = pump.pump_health(classify.well_metrics(late.filter("n >= 680"))).withColumnRenamed("timestamp", "ts").withColumn("phi", F.col("pump_health_index"))
    want = history.with_history(table.select("well_id", "ts", "n", "phi"), cap=5).filter(F.col("ts") < table.agg(F.max("ts")).first()[0] - streams.DELAY_MS)
    columns = ["well_id", "ts", "n_history", "first_ts", F.round("phi_sum", 6), F.round("slope", 3), F.round("intercept", 3), F.round("r2", 3)]
    got, want = (sorted(map(repr, map(tuple, x.select(*columns).collect()))) for x in (got, want))
    assert got == want and len(want) > 50


def test_alarms_served_from_many_batches_of_which_one_is_repeated(spark, tmp_path, wells):
    stream, place = feed(spark, str(tmp_path / "in"), wells, cut(wells, [0, 200, 400, 600, 800, 1000])), str(tmp_path / "pumps")
    streams.serve_pumps(streams.pump_history(stream), place, every=2).awaitTermination()
    columns = ["well_id", "ts", "n", "pump_alarm_level", "rul", "rul_method"]
    once = tuples(streams.served_pumps(spark, place), *columns)
    commits = sorted((tmp_path / "pumps" / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(commits) >= 5
    commits[-1].unlink()  # the last batch was written, but a failure came before it was noted
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    again = streams.serve_pumps(streams.pump_history(stream), place, every=2)
    again.awaitTermination()
    assert tuples(streams.served_pumps(spark, place), *columns) == once
    report = pump.pump_health(classify.well_metrics(wells))
    readings = report.select("well_id", F.col("timestamp").alias("ts"), "n", F.col("pump_health_index").alias("phi"), "failure_mode")
    closed = readings.agg(F.max("ts")).first()[0] - streams.DELAY_MS
    lives = history.remaining_life(history.with_history(readings).filter("failure_mode = 'BEARING_FAILURE_RISK'")).filter(F.col("ts") < closed)
    from fieldwatch.operators import serving

    assert once == tuples(serving.pump_alarms(history.rul_overlay(report.filter(F.col("timestamp") < closed), lives)), *columns)


def test_changes_have_versions_and_merge_to_the_current_values(spark, tmp_path, wells):
    every_other = [wells.filter("n % 40 < 20"), wells.filter("n % 40 >= 20 AND n < 500"), wells.filter("n % 40 >= 20 AND n >= 500")]
    stream, place = feed(spark, str(tmp_path / "in"), wells, every_other), str(tmp_path / "changes")
    streams.keep_changes(compliance.tumbling_stream(stream, ["well_id"], "200 seconds", delay="2 hours"), place).awaitTermination()
    versions = streams.changes(spark, place).groupBy("window_key").agg(F.count("*").alias("n"), F.countDistinct("version").alias("v"))
    assert versions.filter("n > 1 AND n = v").count() > 10 and versions.filter("n <> v").count() == 0
    columns = ["window_start", "window_end", "well_id", F.round("avg_methane", 6), "max_methane", "min_methane", "reading_count"]
    assert tuples(streams.merged(spark, place), *columns) == tuples(compliance.tumbling(wells, ["well_id"], 200_000), *columns)


def test_a_run_goes_on_from_its_checkpoint(spark, tmp_path, wells):
    folder, table, checkpoint = str(tmp_path / "in"), "resumed_kpis", str(tmp_path / "checkpoint")
    halves = cut(wells, [0, 300, 1000])
    windows = lambda s: compliance.tumbling_stream(s, ["well_id"], "100 seconds")
    first = streams.resume(windows(feed(spark, folder, wells, halves[:1])), table, checkpoint).count()
    second = streams.resume(windows(feed(spark, folder, wells, halves[1:])), table, checkpoint)
    nothing_new = streams.resume(windows(feed(spark, folder, wells, [])), table, checkpoint)
    whole = streams.run(windows(feed(spark, str(tmp_path / "whole"), wells, [wells])), "whole")
    columns = ["window_start", "well_id", "avg_methane", "max_methane", "min_methane", "reading_count"]
    assert 0 < first < second.count() and tuples(second, *columns) == tuples(whole, *columns) == tuples(nothing_new, *columns)
    assert second.select("window_start", "well_id").distinct().count() == second.count()


def test_a_failing_query_stops_the_other_and_is_raised(spark, tmp_path, wells):
    stream = feed(spark, str(tmp_path / "in"), wells, cut(wells, [0, 100, 200]))

    def broken(batch, batch_id):
        raise ValueError("a sink that fails")

    endless = spark.readStream.format("rate").load().writeStream.foreachBatch(lambda b, i: None).option("checkpointLocation", str(tmp_path / "c1")).start()
    failing = streams.start_sink(stream, broken, str(tmp_path / "c2"))
    with pytest.raises(Exception, match="a sink that fails"):
        streams.supervise([endless, failing])
    assert not endless.isActive and not failing.isActive


def test_any_or_all_queries_are_awaited(spark, tmp_path, wells):
    stream, seen = feed(spark, str(tmp_path / "in"), wells, cut(wells, [0, 100, 200])), []
    endless = spark.readStream.format("rate").load().writeStream.foreachBatch(lambda b, i: None).option("checkpointLocation", str(tmp_path / "c1")).start()
    streams.supervise([endless, streams.start_sink(stream, lambda b, i: seen.append(b.count()), str(tmp_path / "c2"))], until_all=False)
    assert not endless.isActive and sum(seen) == 200
    two = [streams.start_sink(stream, lambda b, i: seen.append(b.count()), str(tmp_path / f"c{k}")) for k in (3, 4)]
    streams.supervise(two)
    assert sum(seen) == 600 and not any(q.isActive for q in two)
