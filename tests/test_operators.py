"""Joins, history, windows, sinks and searches on small tables made for their corners."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldwatch.operators import anomaly, history, incidents, joins, serving

T0 = 1704067200000


def sides(spark, wells, tanks):
    w = spark.createDataFrame([(f"W{k}", f, t, 1.0, 1.0, "NORMAL", 95) for k, (f, t) in enumerate(wells)], "well_id string, facility_id string, timestamp bigint, methane_ppm double, co2_ppm double, emission_risk_level string, data_quality_score int")
    t = spark.createDataFrame([(f"T{k}", f, t, 50.0, 1.0, "NORMAL", 95) for k, (f, t) in enumerate(tanks)], "tank_id string, facility_id string, timestamp bigint, level_percentage double, vapor_concentration_ppm double, vapor_risk_level string, data_quality_score int")
    return w, t


def test_join_bounds(spark):
    w, t = sides(spark, [("A", T0)], [("A", T0 + 60_000), ("A", T0 - 60_000), ("A", T0 + 60_001), ("A", T0 - 60_001), ("B", T0)])
    assert sorted(r.tank_id for r in joins.interval_join(w, t).collect()) == ["T0", "T1"]


def test_join_equals_plain_join_for_any_split(spark):
    rng = random.Random(1)
    at = lambda: ("A" if rng.random() < 0.9 else rng.choice("BC"), T0 + rng.randrange(600_000))
    wells, tanks = [at() for _ in range(120)], [at() for _ in range(120)]
    w, t = sides(spark, wells, tanks)
    want = sorted((f"W{i}", f"T{j}") for i, (f, a) in enumerate(wells) for j, (g, b) in enumerate(tanks) if f == g and abs(a - b) <= 60_000)
    for splits in (1, 4, 16):
        assert sorted((r.well_id, r.tank_id) for r in joins.interval_join(w, t, splits=splits).collect()) == want
        assert joins.status_counts(w, t, splits=splits).agg(F.sum("n_pairs")).first()[0] == len(want)


def judge(spark, values, level=50.0, risk=20):
    rows = spark.createDataFrame([(T0, v, level, risk, "NORMAL", "NORMAL") for v in values], "well_ts bigint, methane_ppm double, level_percentage double, risk_score int, emission_risk_level string, vapor_risk_level string")
    return anomaly.zscores(rows).collect()


def test_zscores_without_spread(spark):
    assert [(r.methane_zscore, r.is_anomaly) for r in judge(spark, [7.0])] == [(0.0, False)]
    assert {r.methane_zscore for r in judge(spark, [7.0, 7.0])} == {0.0}
    assert [r.is_anomaly for r in judge(spark, [7.0], risk=60)] == [False]
    assert [r.is_anomaly for r in judge(spark, [7.0], risk=80)] == [True]
    assert [r.predictive_maintenance_score for r in judge(spark, [7.0], level=90.0) + judge(spark, [7.0], level=90.1) + judge(spark, [7.0], level=9.9)] == [0, 20, 20]


def readings(spark, times, phi=lambda k: 80.0 - k):
    return spark.createDataFrame([("W", t, k, float(phi(k))) for k, t in enumerate(times)], "well_id string, ts bigint, n bigint, phi double")


@pytest.mark.parametrize("n, last", [(4, 4), (5, 5), (50, 50), (51, 50), (120, 50)])
def test_history_is_capped(spark, n, last):
    rows = history.with_history(readings(spark, [T0 + 60_000 * k for k in range(n)])).orderBy("n").collect()
    assert [r.n_history for r in rows] == [min(k + 1, 50) for k in range(n)]
    assert rows[-1].first_ts == T0 + 60_000 * (n - last)


def test_history_resets_after_an_idle_hour_and_spans_days(spark):
    day = 86_400_000
    times = [T0 + day - 7_000_000, T0 + day - 3_400_001, T0 + day + 199_998, T0 + day + 3_799_998, T0 + 2 * day]
    rows = history.with_history(readings(spark, times)).orderBy("n").collect()
    assert [r.n_history for r in rows] == [1, 2, 3, 1, 1]  # gaps of 3599.999, 3599.999, 3600 and more seconds
    sessions = history.session_summaries(readings(spark, times)).orderBy("session").collect()
    assert [r.n for r in sessions] == [3, 1, 1]
    assert history.history_length(readings(spark, times), times[-1] + 3_599_999).collect()[0].history_length == 1
    assert history.history_length(readings(spark, times), times[-1] + 3_600_000).count() == 0


def test_history_over_days_equals_one_frame(spark):
    times = [T0 + 3_500_000 * k for k in range(200)]  # 24 or 25 a day, never idle
    rows = history.with_history(readings(spark, times)).orderBy("n").collect()
    assert [r.n_history for r in rows] == [min(k + 1, 50) for k in range(200)]
    assert all(math.isclose(r.slope, -1 / (3_500_000 / 3_600_000), rel_tol=1e-6) for r in rows[1:])


def test_remaining_life(spark):
    hour = 600_000
    life = lambda phi, n=10: history.remaining_life(history.with_history(readings(spark, [T0 + hour * k for k in range(n)], phi))).orderBy(F.desc("n")).first()
    assert life(lambda k: 50.0, 4).rul_text == "collecting history (4/5 readings)"
    assert life(lambda k: 50.0).rul_case == "STABLE" and life(lambda k: 50.0).r2 is None
    assert life(lambda k: 50.0 + k).rul_text == "stable or improving (slope=+6.000 PHI/hr, R²=1.00)"
    assert life(lambda k: 30.0 - k).rul_case == "OVERDUE"
    assert life(lambda k: 36.0 - k).rul_case == "MINUTES"
    assert life(lambda k: 60.0 - k).rul_text.endswith(" to critical (LinearRegression: slope=-6.000 PHI/hr, R²=1.00, n=10)")
    assert life(lambda k: 90.0 - k / 10).rul_case == "DAYS"
    same = history.remaining_life(history.with_history(readings(spark, [T0] * 6))).orderBy(F.desc("n")).first()
    assert (same.slope, same.rul_case) == (0.0, "STABLE")


def test_a_batch_written_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "served")
    rows = lambda ids: spark.createDataFrame([(i, T0 + i, T0 + i + 1000) for i in ids], "id bigint, ts bigint, expires_at bigint")
    for batch, ids in ((1, [1, 2]), (2, [3]), (1, [1, 2])):
        serving.write_batch(rows(ids), batch, path, "ts")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert sorted(r.id for r in serving.served(spark, path, T0 + 1002, 1000).collect()) == [3]


def test_lesser_levels_never_clear_an_alarm(spark):
    names = "well_id, timestamp, n, pump_alarm_level, failure_mode, pump_health_index, rul, rul_method, flow_deviation_pct, pressure_deviation_pct, temp_rise_f".split(", ")
    rows = [("W", T0, 1, "L3_CRITICAL", "x", 1.0, "r", "m", 0.0, 0.0, 0.0), ("W", T0 + 1, 2, "NORMAL", "x", 99.0, "r", "m", 0.0, 0.0, 0.0)]
    got = serving.pump_alarms(spark.createDataFrame(rows, names))
    assert [(r.key, r.pump_alarm_level) for r in serving.lookup(got, None, T0 + 599_999).collect()] == [("pump:W:alarm", "L3_CRITICAL")]
    assert serving.lookup(got, "pump:W:alarm", T0 + 600_000).count() == 0


def test_similar_incidents_are_exact_for_any_number_of_cells(spark):
    rng = random.Random(2)
    rows = [(k, [float(rng.gauss(k % 5, 1)) for _ in range(6)]) for k in range(80)]
    vectors = spark.createDataFrame([*rows, (900, [0.0] * 6), (901, None)], "vec_id bigint, embedding array<float>")
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) / math.hypot(*a) / math.hypot(*b)
    want = []
    for q, a in rows[::8]:
        near = sorted((-cosine(a, b), d) for d, b in rows if d != q and cosine(a, b) >= 0.7)[:3]
        want += [(q, d, r + 1) for r, (_, d) in enumerate(near)]
    for cells in (1, 8, 64):
        got = incidents.similar_incidents(vectors.filter("vec_id % 8 = 0 AND vec_id < 900"), vectors, cells=cells)
        assert sorted((r.query_id, r.vec_id, r["rank"]) for r in got.collect()) == sorted(want)


def test_the_latest_alarms_need_no_fallback_from_generated_code(spark, sf_dir):
    from fieldwatch.plans.queries import QUERIES

    spark.conf.set("spark.sql.codegen.fallback", "false")  # a stage too large to compile fails
    try:
        assert QUERIES["pump_alarm_latest"](spark, sf_dir).count() == 20
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
