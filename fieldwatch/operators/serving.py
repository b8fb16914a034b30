"""Latest-state tables with an expiry, their payloads, look-ups, and sinks that a repeated batch doesn't change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.functions.rules import decimal_text

HEALTH_TTL_MS, ALARM_TTL_MS = 300_000, 600_000
ALARM_LEVELS = ("L4_SHUTDOWN", "L3_CRITICAL", "L2_WARNING")


def latest(rows: DataFrame, key: str, order: list[str], where: Column | None = None) -> DataFrame:
    """The last row of each key in the given order, by a grouped maximum that is combined before the shuffle.

    where leaves out rows within the maximum: a filter in front would be pushed down through the rules that made its column, and repeat them until no code is generated for the stage.
    """
    rest = [c for c in rows.columns if c != key and c not in order]
    row = F.struct(*order, *rest)
    newest = rows.groupBy(key).agg(F.max(row if where is None else F.when(where, row)).alias("r"))
    return (newest if where is None else newest.filter("r IS NOT NULL")).select(key, *[F.col(f"r.{c}").alias(c) for c in (*order, *rest)])


def facility_health(judged: DataFrame) -> DataFrame:
    """The newest anomalous joined reading of each facility, its key and when it expires."""
    rows = judged.filter("is_anomaly").select("facility_id", "well_ts", "tank_ts", "well_id", "tank_id", "risk_score", "facility_status", "methane_zscore", "predictive_maintenance_score")
    newest = latest(rows, "facility_id", ["well_ts", "tank_ts", "well_id", "tank_id"])
    return newest.withColumns({"key": F.concat(F.lit("facility:"), "facility_id", F.lit(":health")), "expires_at": F.col("well_ts") + HEALTH_TTL_MS})


def pump_alarms(report: DataFrame) -> DataFrame:
    """The newest alarm of each pump, its key and when it expires. Lesser levels never replace an alarm."""
    rows = report.select(
        "well_id", F.col("timestamp").alias("ts"), "n", "pump_alarm_level", "failure_mode", "pump_health_index", "rul", "rul_method", "flow_deviation_pct", "pressure_deviation_pct", "temp_rise_f"
    )
    newest = latest(rows, "well_id", ["ts", "n"], F.col("pump_alarm_level").isin(*ALARM_LEVELS))
    return newest.withColumns({"key": F.concat(F.lit("pump:"), "well_id", F.lit(":alarm")), "expires_at": F.col("ts") + ALARM_TTL_MS})


def lookup(served: DataFrame, key: str | None, as_of_ms: int) -> DataFrame:
    """Rows of a served table that haven't expired, of one key or all."""
    alive = served.filter(F.col("expires_at") > as_of_ms)
    return alive if key is None else alive.filter(F.col("key") == key)


def _pair(name: str, value: Column, text: bool = False) -> Column:
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"')) if text else F.concat(F.lit(f'"{name}":'), value.cast("string"))


def _json(*pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def facility_payload(batch_ms: int = 5_000) -> Column:
    """JSON of a facility_health row; the batch is the reading's event-time bucket."""
    batch = F.floor(F.col("well_ts") / batch_ms)
    return _json(
        _pair("risk_score", F.col("risk_score")), _pair("status", F.col("facility_status"), True), _pair("methane_zscore", decimal_text(F.col("methane_zscore"), 2)),
        _pair("predictive_maintenance_score", F.col("predictive_maintenance_score")), F.lit('"anomaly":true'), _pair("batch_id", batch),
    )


def alarm_payload(batch_ms: int = 10_000) -> Column:
    """JSON of a pump_alarms row."""
    return _json(
        _pair("alarm", F.col("pump_alarm_level"), True), _pair("failure_mode", F.col("failure_mode"), True), _pair("phi", decimal_text(F.col("pump_health_index"), 1)), _pair("rul", F.col("rul"), True),
        _pair("rul_method", F.col("rul_method"), True), _pair("flow_dev", decimal_text(F.col("flow_deviation_pct"), 1)), _pair("pres_dev", decimal_text(F.col("pressure_deviation_pct"), 1)),
        _pair("temp_rise", decimal_text(F.col("temp_rise_f"), 1)), _pair("batch", F.floor(F.col("ts") / batch_ms)),
    )


def history_entry() -> Column:
    """JSON of one history reading (phi, ts)."""
    return _json(_pair("phi", decimal_text(F.col("phi"), 4)), _pair("ts", F.col("ts")))


def write_batch(batch: DataFrame, batch_id: int, path: str, time_column: str) -> None:
    """A foreachBatch sink: rows by event date and batch id. Writing a batch again replaces just its own partitions, so a retry leaves the same rows.

    Look-ups should filter event_date first, which prunes.
    """
    dated = batch.withColumns({"event_date": F.to_date(F.timestamp_millis(time_column)), "batch_id": F.lit(batch_id)})
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "batch_id").parquet(path)


def served(spark: SparkSession, path: str, as_of_ms: int, ttl_ms: int) -> DataFrame:
    """What write_batch kept and hasn't expired; only the dates that can matter are read."""
    day = F.to_date(F.timestamp_millis(F.lit(as_of_ms - ttl_ms)))
    return spark.read.parquet(path).filter((F.col("event_date") >= day) & (F.col("expires_at") > as_of_ms))
