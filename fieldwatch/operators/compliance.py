"""Tumbling-window compliance tables and alert rows. Windows are aligned to the epoch; bounds are epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.functions.rules import utc_text

KPI_MS, HOUR_MS, DAY_MS = 5_000, 3_600_000, 86_400_000


def _methane() -> dict:
    return {"avg": F.avg("methane_ppm"), "max": F.max("methane_ppm"), "min": F.min("methane_ppm"), "n": F.count("*")}


def tumbling(wells: DataFrame, keys: list[str], size_ms: int) -> DataFrame:
    """Average, largest and smallest methane and the number of readings per window and keys."""
    start = F.floor(F.col("timestamp") / size_ms) * size_ms
    m = _methane()
    rows = wells.groupBy(start.alias("window_start"), *keys).agg(m["avg"].alias("avg_methane"), m["max"].alias("max_methane"), m["min"].alias("min_methane"), m["n"].alias("reading_count"))
    return rows.withColumn("window_end", F.col("window_start") + size_ms)


def well_kpis(wells: DataFrame) -> DataFrame:
    return tumbling(wells, ["well_id"], KPI_MS)


def ldar_hourly(wells: DataFrame) -> DataFrame:
    return tumbling(wells, ["well_id"], HOUR_MS).drop("min_methane")


def facility_daily(wells: DataFrame, size_ms: int = DAY_MS) -> DataFrame:
    """Per facility and day; distinct wells are exact, by a sum per well first and then per facility."""
    start = F.floor(F.col("timestamp") / size_ms) * size_ms
    by_well = wells.groupBy(start.alias("window_start"), "facility_id", "well_id").agg(F.sum("methane_ppm").alias("total"), F.count("methane_ppm").alias("measured"), F.max("methane_ppm").alias("most"), F.count("*").alias("n"))
    by_facility = by_well.groupBy("window_start", "facility_id").agg(
        (F.sum("total") / F.sum("measured")).alias("avg_methane"), F.max("most").alias("max_methane"), F.sum("n").alias("reading_count"), F.count("well_id").alias("well_count")
    )
    return by_facility.withColumn("window_end", F.col("window_start") + size_ms)


def facility_daily_stream(wells: DataFrame, delay: str = "10 seconds", window: str = "24 hours") -> DataFrame:
    """facility_daily on a stream with event_timestamp, in two chained windows, appended when a day is over."""
    by_well = wells.withWatermark("event_timestamp", delay).groupBy(F.window("event_timestamp", window), "facility_id", "well_id").agg(
        F.sum("methane_ppm").alias("total"), F.count("methane_ppm").alias("measured"), F.max("methane_ppm").alias("most"), F.count("*").alias("n")
    )
    days = by_well.groupBy(F.window(F.window_time("window"), window), "facility_id").agg(
        (F.sum("total") / F.sum("measured")).alias("avg_methane"), F.max("most").alias("max_methane"), F.sum("n").alias("reading_count"), F.count("well_id").alias("well_count")
    )
    return with_bounds(days)


def tumbling_stream(wells: DataFrame, keys: list[str], window: str, delay: str = "10 seconds") -> DataFrame:
    """tumbling on a stream with event_timestamp; the output mode says whether changes or final windows come out."""
    m = _methane()
    rows = wells.withWatermark("event_timestamp", delay).groupBy(F.window("event_timestamp", window), *keys).agg(
        m["avg"].alias("avg_methane"), m["max"].alias("max_methane"), m["min"].alias("min_methane"), m["n"].alias("reading_count")
    )
    return with_bounds(rows)


def with_bounds(rows: DataFrame) -> DataFrame:
    """window as window_start and window_end in epoch milliseconds."""
    return rows.select(F.unix_millis("window.start").alias("window_start"), F.unix_millis("window.end").alias("window_end"), *[c for c in rows.columns if c != "window"])


def epa_exceedances(stream: DataFrame) -> DataFrame:
    """Rows of the compliance stream with high emissions, with the regulation's fixed values."""
    return stream.filter("emission_risk_level = 'HIGH_EMISSION'").select(
        "well_id", "facility_id", "methane_ppm", "emission_risk_level", F.lit("EPA_40CFR60_OOOOa").alias("regulation_code"),
        F.lit("LDAR_INSPECTION_REQUIRED").alias("required_action"), utc_text(F.col("timestamp")).alias("detected_at"),
    )


def maintenance_alerts(stream: DataFrame) -> DataFrame:
    return stream.filter("maintenance_alert").select("well_id", "facility_id", "pump_status", "pressure_psi", "flow_rate_bpd", utc_text(F.col("timestamp")).alias("flagged_at"))


def retained(windows: DataFrame, as_of_ms: int, days: int) -> DataFrame:
    """Windows that began within so many days before as_of; on a table partitioned by window_start's date the filter prunes."""
    return windows.filter(F.col("window_start") >= as_of_ms - days * DAY_MS)
