"""The time-tolerant join of a facility's well and tank readings, and the scores of a joined reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldwatch.functions.rules import first_match

ALARMING = "emission_risk_level = 'HIGH_EMISSION' OR vapor_risk_level IN ('HIGH', 'CRITICAL')"
STATUS = [("CRITICAL_ALERT", ALARMING), ("WARNING", "emission_risk_level = 'MEDIUM_EMISSION' OR vapor_risk_level = 'HIGH'")]
CORRELATION = [(95, ALARMING), (75, "emission_risk_level = 'MEDIUM_EMISSION' AND vapor_risk_level = 'HIGH'")]
EMISSION_POINTS = [(40, "emission_risk_level = 'HIGH_EMISSION'"), (20, "emission_risk_level = 'MEDIUM_EMISSION'")]
VAPOR_POINTS = [(40, "vapor_risk_level = 'CRITICAL'"), (20, "vapor_risk_level = 'HIGH'")]


def _sides(wells: DataFrame, tanks: DataFrame) -> tuple[DataFrame, DataFrame]:
    extra = lambda df, side: [f"{c} AS {side}_{c}" for c in ("event_timestamp", "window_time") if c in df.columns]
    known = [c for c in ("mean_methane", "spread_methane") if c in wells.columns]
    well = wells.selectExpr(
        "well_id", "facility_id", "timestamp AS well_ts", "methane_ppm", "co2_ppm", "emission_risk_level", "data_quality_score AS well_data_quality", *known, *extra(wells, "well")
    )
    tank = tanks.selectExpr(
        "tank_id", "facility_id AS tank_facility_id", "timestamp AS tank_ts", "level_percentage", "vapor_concentration_ppm", "vapor_risk_level", "data_quality_score AS tank_data_quality",
        *extra(tanks, "tank"),
    )
    return well, tank


#: How many tolerances wide a time bucket is. A reading's interval of two tolerances touches one or two: 1.5 in the mean.
WIDTH = 4
#: The same on streams.
STREAM_WIDTH = 2


def bucketed(wells: DataFrame, tanks: DataFrame, tolerance_ms: int, splits: int) -> DataFrame:
    """Pairs of rows (well_ts, facility_id; tank_ts, tank_facility_id) of one facility whose times differ by at most the tolerance, both ends included.

    Wells are repeated for the one or two time buckets their interval touches, so a facility's rows spread over its buckets; ``splits`` divides a bucket's
    tanks further, each part meeting all its wells, at the price of as many copies of the wells; with one, a partition that a dense facility makes large is
    divided by adaptive execution. The result doesn't depend on it. Both sides are shuffled: what a side's files weigh says nothing
    about its rows here, so neither may be broadcast for it.
    """
    width = WIDTH * max(tolerance_ms, 1)
    buckets = F.explode(F.sequence(F.floor((F.col("well_ts") - tolerance_ms) / width), F.floor((F.col("well_ts") + tolerance_ms) / width)))
    left = wells.withColumn("__bucket", buckets).withColumn("__split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    right = tanks.withColumn("__bucket", F.floor(F.col("tank_ts") / width)).withColumn("__split", F.pmod(F.xxhash64("tank_ts", *[c for c in ("tank_id",) if c in tanks.columns]), F.lit(splits)).cast("int"))
    met = (F.col("facility_id") == F.col("tank_facility_id")) & (left["__bucket"] == right["__bucket"]) & (left["__split"] == right["__split"])
    exact = F.abs(F.col("well_ts") - F.col("tank_ts")) <= tolerance_ms
    return left.hint("merge").join(right.hint("merge"), met & exact).drop("__bucket", "__split", "tank_facility_id")


def scored(joined: DataFrame) -> DataFrame:
    """Correlation score, status and risk score of joined readings."""
    return joined.select(
        "*",
        first_match(CORRELATION, 50).alias("correlation_score"),
        first_match(STATUS, "NORMAL").alias("facility_status"),
        (first_match(EMISSION_POINTS, 10) + first_match(VAPOR_POINTS, 10)).alias("risk_score"),
    )


def interval_join(wells: DataFrame, tanks: DataFrame, tolerance_ms: int = 60_000, splits: int = 1, min_correlation: int = 50) -> DataFrame:
    """Clean well and tank readings of a facility within the tolerance, scored; those below the least correlation go."""
    return scored(bucketed(*_sides(wells, tanks), tolerance_ms, splits)).filter(F.col("correlation_score") >= min_correlation)


def interval_join_stream(wells: DataFrame, tanks: DataFrame, tolerance: str = "60 seconds", delay: str = "10 seconds", window: str | None = None) -> DataFrame:
    """The same of two streams with event_timestamp. State older than the tolerance and the delay is dropped.

    The time bucket is part of the key, so a row looks at the state of its facility's buckets, not at all that the facility has in a batch. Each look is a look-up in
    the state, dearer than a copy of the row, so buckets are narrower than a table's. The bounds in whole microseconds come first: those with intervals, by which old
    state goes, are reckoned by the calendar for every pair that is left. Wells that met something by windows of a given length have that watermark in window_time,
    and event_timestamp is an ordinary column.
    """
    well, tank = _sides(wells if window else wells.withWatermark("event_timestamp", delay), tanks.withWatermark("event_timestamp", delay))
    within = f"unix_micros(timestamp_micros(0L) + INTERVAL {tolerance})"
    bucket = lambda time: f"floor({time} / ({STREAM_WIDTH} * greatest(1L, {within})))"
    at = "unix_micros(well_event_timestamp)"
    well = well.withColumn("__bucket", F.expr(f"explode(sequence({bucket(f'({at} - {within})')}, {bucket(f'({at} + {within})')}))"))
    tank = tank.withColumn("__tank_bucket", F.expr(bucket("unix_micros(tank_event_timestamp)")))
    near = f"facility_id = tank_facility_id AND __bucket = __tank_bucket AND abs({at} - unix_micros(tank_event_timestamp)) <= {within} AND tank_event_timestamp >= well_event_timestamp - INTERVAL {tolerance} AND tank_event_timestamp <= well_event_timestamp + INTERVAL {tolerance}"
    if window:  # follows from the others; by it old state goes
        near += f" AND tank_event_timestamp >= well_window_time - INTERVAL {tolerance} - INTERVAL {window} AND tank_event_timestamp <= well_window_time + INTERVAL {tolerance}"
    return scored(well.join(tank, F.expr(near), "inner").drop("tank_facility_id", "__bucket", "__tank_bucket"))


def status_counts(wells: DataFrame, tanks: DataFrame, tolerance_ms: int = 60_000, splits: int = 1) -> DataFrame:
    """Pairs per facility, status and risk score. Equal readings are counted before the join, so fewer pairs are made."""
    well, tank = _sides(wells, tanks)
    few_wells = well.groupBy("facility_id", "well_ts", "emission_risk_level").agg(F.count("*").alias("n_wells"))
    few_tanks = tank.groupBy("tank_facility_id", "tank_ts", "vapor_risk_level").agg(F.count("*").alias("n_tanks"))
    pairs = scored(bucketed(few_wells, few_tanks, tolerance_ms, splits))
    return pairs.groupBy("facility_id", "facility_status", "risk_score").agg(F.sum(F.col("n_wells") * F.col("n_tanks")).alias("n_pairs"))
