"""Methane z-scores, anomalies and the vectors and events made of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.functions.rules import first_match
from fieldwatch.operators.joins import EMISSION_POINTS, VAPOR_POINTS

BUCKET_MS = 5000
MEAN_IF_NONE, SPREAD_IF_NONE = 200.0, 1.0


def _zscore() -> Column:
    """Of methane_ppm, mean_methane and spread_methane."""
    return (F.col("methane_ppm") - F.coalesce("mean_methane", F.lit(MEAN_IF_NONE))) / F.coalesce(F.nullif(F.col("spread_methane"), F.lit(0.0)), F.lit(SPREAD_IF_NONE))


def _is_anomaly(limit: float, risk: int) -> Column:
    return (F.abs("methane_zscore") > limit) | (F.col("risk_score") > risk)


def judged(rows: DataFrame, limit: float = 2.0, risk: int = 60) -> DataFrame:
    """Adds methane_zscore, predictive_maintenance_score and is_anomaly to joined readings with mean_methane and spread_methane, which go."""
    level = first_match([(20, "level_percentage > 90 OR level_percentage < 10")], 0)
    with_z = rows.withColumns({"methane_zscore": _zscore(), "predictive_maintenance_score": first_match(EMISSION_POINTS, 0) + first_match(VAPOR_POINTS, 0) + level})
    return with_z.withColumn("is_anomaly", _is_anomaly(limit, risk)).drop("mean_methane", "spread_methane")


def zscores(joined: DataFrame, bucket_ms: int = BUCKET_MS, wells: DataFrame | None = None, join: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """z-scores of joined readings within event-time buckets of the facility query's trigger; a well reading counts once for each tank it meets.

    Means and sample deviations are combined before the shuffle and joined back by bucket: their number grows with time. Where ``join`` made joined of
    ``wells``, they go to the well readings, which are joined again: a reading meets many tanks, and its pairs aren't shuffled by bucket.
    """
    bucket = lambda time: F.floor(F.col(time) / bucket_ms)
    stats = joined.groupBy(bucket("well_ts").alias("bucket")).agg(F.avg("methane_ppm").alias("mean_methane"), F.stddev_samp("methane_ppm").alias("spread_methane"))
    with_stats = lambda rows, time: rows.withColumn("bucket", bucket(time)).hint("merge").join(stats, "bucket")
    return judged(with_stats(joined, "well_ts") if join is None else join(with_stats(wells, "timestamp")))


def _stream_stats(joined: DataFrame, window: str, salts: int) -> DataFrame:
    """Mean and sample deviation of the windows of joined readings on a stream, repeated for each salt."""
    stats = joined.groupBy(F.window("well_event_timestamp", window).alias("w")).agg(F.avg("methane_ppm").alias("mean_methane"), F.stddev_samp("methane_ppm").alias("spread_methane"))
    return stats.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def anomalous_stream(joined: DataFrame, salts: int = 4, window: str = "5 seconds", limit: float = 2.0, risk: int = 60) -> DataFrame:
    """The anomalous well readings of a stream of joined readings, each once, with their window (w, well_id, well_ts, methane_zscore).

    A z-score doesn't depend on the tank that a reading met, and one of a reading's pairs passes the bound of the risk if the greatest does. So a reading's pairs are
    combined, before the shuffle as far as they are in one place, and what is held until a window closes and its statistics are known are readings.
    """
    readings = joined.groupBy(F.window("well_event_timestamp", window).alias("w"), "well_id", "well_ts", "methane_ppm").agg(F.max("risk_score").alias("risk_score"))
    salted = readings.withColumn("salt", F.pmod(F.xxhash64("well_id", "well_ts"), F.lit(salts)).cast("int"))
    scored = salted.join(_stream_stats(joined, window, salts), ["w", "salt"]).withColumn("methane_zscore", _zscore())
    return scored.filter(_is_anomaly(limit, risk)).groupBy("w", "well_id", "well_ts").agg(F.max("methane_zscore").alias("methane_zscore"))


def zscores_stream(joined: DataFrame, salts: int = 4, window: str = "5 seconds", wells: DataFrame | None = None, join: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The same on a stream: the windows' statistics, repeated for each salt, meet the readings of their window, divided among the salts.

    Both branches read and join the source, which is the price of never gathering a window's rows in one place. Where ``join`` made joined of ``wells``, with event_timestamp
    and its watermark, statistics go to those, which are joined again with the watermark in window_time: what is held until a window closes are readings then, not their
    many pairs. What follows on the stream waits for the second join too.
    """
    w = lambda time: F.window(time, window)
    stats = _stream_stats(joined, window, salts)
    salted = lambda rows, time, *by: rows.withColumn("w", w(time)).withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    if join is None:
        return judged(salted(joined, "well_event_timestamp", "well_id", "tank_id").join(stats, ["w", "salt"])).drop("salt")
    rows = salted(wells, "event_timestamp", "well_id").withColumn("event_timestamp", F.expr("event_timestamp + INTERVAL 0 SECONDS"))  # a join takes one event time a side
    return judged(join(rows.join(stats, ["w", "salt"]).withColumn("window_time", F.window_time("w")).drop("w", "salt")))


FEATURES = ["methane_ppm", "co2_ppm", "vapor_concentration_ppm", "level_percentage"]


def sensor_features(rows: DataFrame) -> DataFrame:
    """Adds sensor_features, a vector; rows with a missing part go."""
    return VectorAssembler(inputCols=FEATURES, outputCol="sensor_features", handleInvalid="skip").transform(rows)


def anomaly_events(judged_rows: DataFrame, report: DataFrame) -> DataFrame:
    """One event per anomalous well reading of a running pump. The z-score doesn't depend on the tank a reading met, so a reading counts once."""
    once = judged_rows.filter("is_anomaly").groupBy("well_id", "well_ts").agg(F.max("methane_zscore").alias("methane_zscore"), F.max("risk_score").alias("risk_score"))
    pumps = report.select("well_id", F.col("timestamp").alias("well_ts"), "facility_id", "methane_ppm", "emission_risk_level", "pump_health_index", "pump_alarm_level", "pressure_psi", "temp_rise_f", "flow_deviation_pct", "failure_mode", "recommended_action")
    return once.hint("merge").join(pumps.hint("merge"), ["well_id", "well_ts"])


def anomaly_type() -> Column:
    """Of an anomaly event; the first that holds."""
    return first_match(
        [
            ("SCALE_WAX_BUILDUP", "flow_deviation_pct < -15 AND (pressure_psi - 300) / 300 * 100 > 20"),
            ("BEARING_DEGRADATION", "temp_rise_f > 30"),
            ("SEAL_FAILURE", "temp_rise_f > 25 AND flow_deviation_pct BETWEEN -10 AND 5 AND (pressure_psi - 300) / 300 * 100 BETWEEN -10 AND 10"),
            ("GAS_INTERFERENCE_CAVITATION", "methane_ppm > 400 AND flow_deviation_pct < -10"),
            ("EMISSION_EXCEEDANCE", "methane_zscore > 3.5D OR methane_ppm > 500"),
            ("MECHANICAL_FAILURE", "flow_deviation_pct < -20 AND (pressure_psi - 300) / 300 * 100 < -15"),
        ],
        "NORMAL_VARIANCE",
    )
