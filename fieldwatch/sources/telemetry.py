"""Well and tank readings from files and tables, and as derived from the driver's events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.sources.schemas import EVENTS, TANK, WELL

#: 2024-01-01 in epoch milliseconds, where derived telemetry begins.
T0 = 1704067200000
PROFILES = {
    "fast": f"{T0} + n * 1000 + (u * {{step}}) % 1000",
    "mixed": f"{T0} + n * 1000 + (u * {{step}}) % 1000 + (n div 4000) * 3700000",
    "slow": "unix_micros(cast(ts as timestamp)) div 1000",
}
"""A reading a second; the same with an idle hour after every 4000 events; the events' own times over thirty days."""
STEPS = {"well": 7919, "tank": 6101}
"""What a kind's readings are moved by within their second."""


def read_telemetry(spark: SparkSession, path: str, kind: str, streaming: bool = False, form: str = "parquet") -> DataFrame:
    """Readings of a kind (well or tank) from files of a form, as a table or a stream."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema({"well": WELL, "tank": TANK}[kind]).format(form).load(path)


def events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The driver's events; as a stream, straight from the given table, be it one file or a folder of part files."""
    table = f"{sf_dir}/events.parquet"
    if streaming:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
            return spark.readStream.schema(EVENTS).parquet(table)
        return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return spark.read.schema(EVENTS).parquet(table)


def with_time(source: DataFrame, kind: str, profile: str = "fast", name: str = "__at") -> DataFrame:
    """Events with the time of the reading of a kind (well or tank) that is derived from them."""
    return source.withColumns({"n": F.col("event_id"), "u": F.col("user_id")}).withColumn(name, F.expr(PROFILES[profile].format(step=STEPS[kind]))).drop("n", "u")


def wells(source: DataFrame, profile: str = "fast") -> DataFrame:
    """One well reading per event, in the well schema, with the event's number as n. The 18th well degrades, in a sawtooth, so that it shows bearing faults at any size."""
    spread = lambda low, a, b, size: f"{low} + ((n * {a} + u * {b}) % {size}) / 100.0D"
    return source.selectExpr("event_id AS n", "user_id AS u", "ts").selectExpr(
        "concat('WELL-', n % 20 + 1) AS well_id",
        "concat('FAC-', n % 10 + 1) AS facility_id",
        f"{PROFILES[profile].format(step=STEPS['well'])} AS timestamp",
        f"{spread(5, 7919, 104729, 79501)} AS methane_ppm",
        f"{spread(10, 6101, 15485863, 99001)} AS co2_ppm",
        f"CASE WHEN n % 20 = 17 THEN 300.0D ELSE {spread(100, 7927, 49979, 40001)} END AS pressure_psi",
        f"CASE WHEN n % 20 = 17 THEN 112.0D + (n % 2000) / 100.0D ELSE {spread(50, 4447, 32452843, 8001)} END AS temperature_f",
        f"CASE WHEN n % 20 = 17 THEN 160.0D - (n % 4000) / 100.0D WHEN n % 20 = 3 THEN 170.0D ELSE {spread(50, 3571, 86028121, 25001)} END AS flow_rate_bpd",
        "base64(cast(concat('vib_', n) AS binary)) AS vibration_encoded",
        "element_at(array('active', 'inactive', 'standby'), cast((n + u) % 3 + 1 AS int)) AS pump_status",
        "u % 7 = 0 AS maintenance_alert",
        "n",
    )


def tanks(source: DataFrame, profile: str = "fast") -> DataFrame:
    """One tank reading per event, in the tank schema, with the event's number as n."""
    spread = lambda low, a, b, size: f"{low} + ((n * {a} + u * {b}) % {size}) / 100.0D"
    return source.selectExpr("event_id AS n", "user_id AS u", "ts").selectExpr(
        "concat('TANK-', n % 15 + 1) AS tank_id",
        "concat('FAC-', n % 10 + 1) AS facility_id",
        f"{PROFILES[profile].format(step=STEPS['tank'])} AS timestamp",
        f"{spread(5, 7919, 224737, 9001)} AS level_percentage",
        f"{spread(100, 15485867, 1299709, 1490001)} AS vapor_concentration_ppm",
        "element_at(array('NORMAL', 'LEAK_DETECTED', 'CRITICAL'), cast((n + u) % 3 + 1 AS int)) AS leak_detection_status",
        f"{spread(40, 6113, 7057, 7001)} AS ambient_temperature_f",
        f"{spread(5, 5507, 9041, 4501)} AS internal_pressure_psi",
        "u % 2 = 0 AS flame_arrestor_status",
        "u % 3 = 0 AS vapor_recovery_active",
        "u % 11 = 0 AS emergency_shutdown",
        f"{spread(0, 4177, 8101, 3001)} AS wind_speed_mph",
        f"{spread(950, 3301, 6203, 10001)} AS atmospheric_pressure_mb",
        "cast((n * 31 + u * 17) % 501 AS int) AS air_quality_index",
        "n",
    )


def with_event_time(readings: DataFrame) -> DataFrame:
    """Adds event_timestamp from timestamp, epoch milliseconds; works on streams."""
    return readings.withColumn("event_timestamp", F.timestamp_millis("timestamp"))
