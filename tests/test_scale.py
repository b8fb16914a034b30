"""Steps whose cost must grow with the input only: how they are planned, and that their results stay those of the plain form."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldwatch.operators import anomaly, incidents, joins, nearest
from fieldwatch.plans.queries import QUERIES
from fieldwatch.streaming import state, streams
from test_operators import T0, sides


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["facility_health_latest", "facility_payloads", "health_lookup", "maintenance_band", "methane_zscore", "sensor_features", "anomaly_types"])
def test_readings_are_not_broadcast_for_their_files_weight(spark, sf_dir, name):
    assert "BroadcastExchange" not in plan(QUERIES[name](spark, sf_dir))


def events_table(spark, place):
    """Events every second over some minutes; every tenth comes twice and some lack their user."""
    rows = [(k, None if k % 97 == 0 else k * 7 % 300) for k in range(900) for _ in range(1 + (k % 10 == 0))]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint")
    events.selectExpr("event_id", "timestamp_seconds(1704067200 + event_id) AS ts", "user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props").coalesce(2).write.parquet(f"{place}/events.parquet")
    return str(place)


AFTER_THE_JOIN = ["facility_payloads", "health_lookup", "maintenance_band", "methane_zscore"]


@pytest.mark.parametrize("name", AFTER_THE_JOIN)
def test_no_broadcast_is_chosen_at_run_time(spark, tmp_path, name):
    """Adaptive execution may turn a join of small shuffled sides into a broadcast; here every join must stay one of shuffled sides."""
    done = QUERIES[name](spark, events_table(spark, tmp_path))
    assert done.count() == len(done.collect()) > 0
    assert "isFinalPlan=true" in plan(done) and "SortMergeJoin" in plan(done) and "Broadcast" not in plan(done)


@pytest.mark.parametrize("name", [*AFTER_THE_JOIN, "incident_records", "incident_log", "incident_texts"])
def test_pairs_of_readings_are_not_shuffled(spark, tmp_path, name):
    """What an exchange gets from the interval join has been combined before."""
    nodes = plan(QUERIES[name](spark, events_table(spark, tmp_path))).split("\n")
    below = [next(n for n in nodes[k + 1 :] if "Aggregate(" in n or "Join [" in n or "FileScan" in n) for k, n in enumerate(nodes) if " Exchange hashpartitioning" in n]
    assert len(below) >= 5 and not [n for n in below if "Join [" in n and "__bucket" in n]


def test_the_joined_stream_has_the_bucket_in_its_key(spark, tmp_path):
    """Else a reading looks at all readings that its facility has in a batch."""
    joined = streams.joined(spark, events_table(spark, tmp_path))
    keys = next(r for r in joined._jdf.queryExecution().analyzed().toString().split("\n") if "Join Inner" in r)
    assert joined.isStreaming and "facility_id" in keys and "__bucket" in keys and "__tank_bucket" in keys


def test_readings_are_not_repeated_for_each_split(spark):
    """A reading's interval touches one bucket or two."""
    w, t = sides(spark, [("A", T0 + 7_001 * k) for k in range(200)], [("A", T0 + 5_003 * k) for k in range(300)])
    touched = joins.interval_join(w, t).groupBy("well_id").agg(F.count("*").alias("n"), F.countDistinct("tank_id").alias("d"))
    assert touched.filter("n <> d").count() == 0
    copies = [r for r in plan(joins.interval_join(w, t)).split("\n") if "Generate explode(sequence" in r]
    assert len(copies) == 1 and "240000.0" in copies[0]


def test_statistics_go_to_readings_before_their_pairs(spark):
    w, t = sides(spark, [("AB"[k % 2], T0 + 700 * k) for k in range(300)], [("AB"[k % 2], T0 + 20_000 * k) for k in range(20)])
    w = w.withColumn("methane_ppm", F.xxhash64("well_id") % 1000 / 10.0)
    join = lambda rows: joins.interval_join(rows, t)
    again = anomaly.zscores(join(w), wells=w, join=join)
    plain = anomaly.zscores(join(w))
    names = ["well_id", "tank_id", "well_ts", "tank_ts", "risk_score", "predictive_maintenance_score", "is_anomaly"]
    show = lambda df: sorted(map(tuple, df.select(*names, F.round("methane_zscore", 9)).collect()))
    assert show(again) == show(plain) and len(show(plain)) > 300
    last = lambda df: next(r for r in plan(df.select(*names, "methane_zscore")).split("\n") if "SortMergeJoin" in r)
    assert "__bucket" in last(again) and "__bucket" not in last(plain)


def test_streams_join_by_time_bucket(spark):
    event = lambda df: df.withColumn("event_timestamp", F.timestamp_millis("timestamp"))
    w, t = sides(spark, [("A", T0), ("A", T0 + 239_999), ("A", -1)], [("A", T0 + 60_000), ("A", T0 - 60_000), ("A", T0 + 60_001), ("A", T0 + 299_999), ("A", 59_999), ("A", -60_001), ("A", -60_002), ("B", T0)])
    joined = joins.interval_join_stream(event(w), event(t))
    assert sorted((r.well_id, r.tank_id) for r in joined.collect()) == [("W0", "T0"), ("W0", "T1"), ("W1", "T3"), ("W2", "T4"), ("W2", "T5")]
    assert "__bucket" in joined._jdf.queryExecution().optimizedPlan().toString() and "__bucket" not in joined.columns


def test_stream_statistics_go_to_readings_before_their_pairs(spark):
    """Pairs aren't held until their window closes; the readings at a window's ends and a tolerance away are still met."""
    event = lambda df: df.withColumn("event_timestamp", F.timestamp_millis("timestamp"))
    w, t = sides(spark, [("AB"[k % 2], T0 + 625 * k) for k in range(200)], [("AB"[k % 2], T0 + 20_000 * k + d) for k in range(10) for d in (0, -1)])
    w, t = event(w.withColumn("methane_ppm", F.xxhash64("well_id") % 1000 / 10.0)), event(t)
    joined = joins.interval_join_stream(w, t)
    again = anomaly.zscores_stream(joined, wells=w, join=lambda rows: joins.interval_join_stream(rows, t, window="5 seconds"))
    names = ["well_id", "tank_id", "well_ts", "tank_ts", "risk_score", "predictive_maintenance_score", "is_anomaly"]
    show = lambda df: sorted(map(tuple, df.select(*names, F.round("methane_zscore", 9)).collect()))
    assert show(again) == show(anomaly.zscores_stream(joined)) and len(show(again)) > 300
    assert next(r for r in plan(again).split("\n") if "Join" in r).count("__bucket") >= 1


def test_frames_are_made_in_parts(monkeypatch):
    """Their arrays hold cap values a reading, so a batch's readings of a well can't all be framed at once."""
    rng = np.random.default_rng(3)
    ts = T0 + np.cumsum(rng.choice([1_000, 60_000, 3_600_000], 1000, p=[0.5, 0.47, 0.03]))
    phi = np.repeat(rng.integers(8, 100, 250), 4).astype(float)
    whole, sizes, plain = state.frames(ts, phi, 50, 3_600_000), [], state.frames
    monkeypatch.setattr(state, "frames", lambda t, *rest: sizes.append(len(t)) or plain(t, *rest))
    for first, last, part in ((0, 1000, 64), (49, 1000, 7), (30, 700, 300), (10, 10, 64)):
        parts = list(state.sliced_frames(ts, phi, first, last, 50, 3_600_000, part))
        assert [k for b, e, _ in parts for k in range(b, e)] == list(range(first, last))
        for b, e, found in parts:
            for name, values in found.items():
                np.testing.assert_allclose(values, whole[name][b:e], rtol=1e-6, atol=1e-6)
    assert max(sizes) <= 300 + 49


def test_held_texts_keep_their_nulls():
    rows = pd.DataFrame({"ts": [2, 1], "n": [1, 2], "phi": [1.0, 2.0], "extra": ["a", None], "well_id": "W"})
    assert state.texts(state.packed(rows)) == ["a", None]
    assert list(state.packed(rows).columns) == state.HELD


def test_held_readings_as_bytes_come_back_the_same():
    rows = state.packed(pd.DataFrame({"ts": range(9000), "n": range(9000), "phi": np.arange(9000) / 3, "extra": [None, *(f'{{"a":{k}}}' for k in range(8999))]}))
    kept = state.to_bytes(rows)
    pd.testing.assert_frame_equal(state.from_bytes(kept), rows)
    assert len(kept) < 9000 * 24
    empty = state.packed(rows.iloc[:0])
    assert len(state.from_bytes(state.to_bytes(empty))) == 0


def test_vectors_are_compared_by_blocks_not_pair_by_pair(spark, monkeypatch):
    """Copies tie by id in every block, an id may come twice, and small blocks give the same as one."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8)).astype("float32")
    rows = [(k, [float(x) for x in base[k % 60]]) for k in range(300)]
    vectors = spark.createDataFrame([*rows, (7, rows[9][1]), (None, rows[20][1]), (400, None), (401, [0.0] * 8), (402, [1.0] * 3), (420, [1.0, 1.0, 1.0])], "vec_id bigint, embedding array<float>")
    unit = lambda v: np.array(v, "float32").astype(float) / np.sqrt((np.array(v, "float32").astype(float) ** 2).sum())
    units, want = [(k, unit(v)) for k, v in [*rows, (7, rows[9][1])]], []
    for q, a in units:
        if q % 20 == 0:
            near = sorted((-round(float(a @ b), 9), d) for d, b in units if d != q and a @ b >= 0.35)[:3]
            want += [(q, d, r) for r, (_, d) in enumerate(near, 1)]
    for size in (nearest.DATA_BLOCK, 16):
        monkeypatch.setattr(nearest, "DATA_BLOCK", size)
        monkeypatch.setattr(nearest, "QUERY_BLOCK", size)
        got = incidents.similar_incidents(vectors.filter("vec_id % 20 = 0"), vectors, threshold=0.35)
        assert sorted((r.query_id, r.vec_id, r["rank"]) for r in got.collect()) == sorted([*want, (420, 402, 1)])
    assert "FlatMapGroupsInPandas" in plan(got)
