"""Streams of a table that is too large for one micro-batch: its events come in bounded batches, in the order of their times, and the rows stay those of the SQL."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from fieldwatch.operators import anomaly, joins
from fieldwatch.plans.oracle import SQL
from fieldwatch.plans.queries import QUERIES
from fieldwatch.streaming import stores, streams
from test_operators import T0, sides


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Events every second, in files of no order in time; every tenth comes twice and some lack their user."""
    place = tmp_path_factory.mktemp("events")
    rows = [(k, None if k % 97 == 0 else k * 7 % 300) for k in range(900) for _ in range(1 + (k % 10 == 0))]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint").repartition(3, F.col("event_id") % 17)
    events.selectExpr("event_id", "cast(timestamp_seconds(1704067200 + event_id) AS timestamp_ntz) AS ts", "user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props").write.parquet(f"{place}/events.parquet")
    return str(place)


def checkpoints(spark):
    return {p.parent for p in Path(streams.checkpoint_root(spark)).rglob("commits")}


def committed(checkpoint):
    return len([p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()])


@pytest.mark.parametrize("name", ["stream_anomaly_events", "stream_interval_join", "stream_served_keys"])
def test_many_batches_yield_the_rows_of_the_sql(spark, table, monkeypatch, name):
    monkeypatch.setattr(streams, "FILE_ROWS", 600)
    monkeypatch.setattr(streams, "BATCH_FILES", 1)
    before = checkpoints(spark)
    got = QUERIES[name](spark, table)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{table}/events.parquet/*.parquet'")
    names = ", ".join(f'"{c}"' for c in got.columns)
    want = con.sql(f"SELECT {names} FROM ({SQL[name]})").fetchall()
    plain = lambda rows: sorted(repr([x + 0.0 if isinstance(x, float) else x for x in r]) for r in rows)  # noqa: E731  # a zero may be negative
    assert plain(got.collect()) == plain(want) and len(want) > 10
    assert max(committed(c) for c in checkpoints(spark) - before) >= 3


def test_a_replays_files_are_ranges_of_time_in_the_order_they_are_taken(spark, table, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    before, stream = checkpoints(spark), streams.replay(spark, table, "well")
    assert stream.isStreaming and streams.run(stream, "replayed").count() == 990
    assert [committed(c) for c in checkpoints(spark) - before] == [3]
    place = max((p for p in Path(streams.checkpoint_root(spark)).glob("replay-*")), key=lambda p: p.stat().st_mtime)
    files = sorted(place.glob("*.parquet"), key=lambda p: p.stat().st_mtime)
    spans = [tuple(x) for x in (spark.read.parquet(str(p)).selectExpr("min(event_id)", "max(event_id)", "count(*)").first() for p in files)]
    spans = [(a, b) for a, b, n in spans if n]
    assert len(spans) > streams.BATCH_FILES and sum(spark.read.parquet(str(p)).count() for p in files) == 990
    timed = [(a, b) for a, b in spans if a > 0]  # the first file has the readings without a time
    assert all(b < c for (_, b), (c, _) in zip(timed, timed[1:], strict=False))


def test_without_ages_all_files_are_one_batch(spark, table, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    monkeypatch.setattr(stores, "aged_by_name", lambda *_: False)
    before = checkpoints(spark)
    assert streams.run(streams.replay(spark, table, "tank"), "at_once").count() == 990
    assert [committed(c) for c in checkpoints(spark) - before] == [1]


def test_state_is_spread_by_cores_and_settings_come_back(spark, table):
    name = "spark.sql.shuffle.partitions"
    asked = spark.conf.get(name)
    spark.conf.set(name, 60)
    try:
        before = checkpoints(spark)
        assert streams.well_kpis(spark, table).count() > 0
        (new,) = checkpoints(spark) - before
        assert len([p for p in (new / "state" / "0").iterdir() if p.name.isdigit()]) == streams.STATE_PARTITIONS * spark.sparkContext.defaultParallelism < 60
        assert spark.conf.get(name) == "60"
    finally:
        spark.conf.set(name, asked)


def test_anomalous_readings_are_combined_before_they_meet_their_windows_statistics(spark):
    """A reading that met many tanks is held once until its window closes."""
    event = lambda df: df.withColumn("event_timestamp", F.timestamp_millis("timestamp"))
    w, t = sides(spark, [("AB"[k % 2], T0 + 625 * (k // 2)) for k in range(400)], [("AB"[k % 2], T0 + 20_000 * k) for k in range(20)])
    w = event(w.withColumn("methane_ppm", F.xxhash64("well_id") % 1000 / 10.0))
    joined = joins.interval_join_stream(w, event(t)).withColumn("risk_score", F.when(F.xxhash64("well_id", "tank_id") % 9 == 0, 80).otherwise(F.col("risk_score")))
    found = anomaly.anomalous_stream(joined, limit=1.5)
    pairs = anomaly.judged(joined.withColumn("w", F.window("well_event_timestamp", "5 seconds")).join(joined.groupBy(F.window("well_event_timestamp", "5 seconds").alias("w")).agg(F.avg("methane_ppm").alias("mean_methane"), F.stddev_samp("methane_ppm").alias("spread_methane")), "w"), limit=1.5)
    want = pairs.filter("is_anomaly").groupBy("well_id", "well_ts").agg(F.max("methane_zscore").alias("methane_zscore"))
    show = lambda df: sorted(map(tuple, df.select("well_id", "well_ts", F.round("methane_zscore", 9)).collect()))
    assert show(found) == show(want) and 20 < len(show(want)) < 400
    nodes = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    met = next(k for k, n in enumerate(nodes) if "Join" in n and "salt" in n)
    assert "Aggregate" in "".join(nodes[met + 1 : next(k for k, n in enumerate(nodes) if k > met and "Join" in n)])
