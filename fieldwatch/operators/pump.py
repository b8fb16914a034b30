"""Pump health: deviations from the pump curve, health index, fault, alarm level. Projections only: no shuffle, tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.functions.rules import first_match
from fieldwatch.operators.classify import active_pumps

#: The design point, and bounds, weights, names and texts of the rules.
DESIGN = {"design_flow_bpd": 175.0, "design_pressure_psi": 300.0, "design_temperature_f": 90.0}
PHI_PARTS = {
    "phi_flow": ([(100.0, "flow_deviation_pct >= -5"), (75.0, "flow_deviation_pct >= -15"), (45.0, "flow_deviation_pct >= -30"), (20.0, "flow_deviation_pct >= -50")], 5.0),
    "phi_pressure": ([(100.0, "pressure_deviation_pct BETWEEN -10 AND 15"), (75.0, "pressure_deviation_pct BETWEEN -20 AND 25"), (45.0, "pressure_deviation_pct BETWEEN -30 AND 40")], 15.0),
    "phi_thermal": ([(100.0, "temp_rise_f < 10"), (80.0, "temp_rise_f < 20"), (50.0, "temp_rise_f < 35"), (25.0, "temp_rise_f < 50")], 5.0),
    "phi_vibration": ([(100.0, "vibration_severity < 0.28D"), (75.0, "vibration_severity < 0.45D"), (35.0, "vibration_severity < 0.71D")], 5.0),
}
WEIGHTS = {"phi_flow": 0.40, "phi_pressure": 0.30, "phi_thermal": 0.20, "phi_vibration": 0.10}
MODES = [
    ("SCALE_WAX_BUILDUP", "flow_deviation_pct < -15 AND pressure_deviation_pct > 20"),
    ("IMPELLER_WEAR", "flow_deviation_pct < -20 AND pressure_deviation_pct < -15"),
    ("BEARING_FAILURE_RISK", "temp_rise_f > 30 AND vibration_severity > 0.45D"),
    ("SEAL_DEGRADATION", "temp_rise_f > 25 AND flow_deviation_pct BETWEEN -10 AND 5 AND pressure_deviation_pct BETWEEN -10 AND 10"),
    ("GAS_INTERFERENCE_CAVITATION", "gvf_risk_flag = 1"),
    ("MECHANICAL_IMBALANCE_CAVITATION", "vibration_severity > 0.45D AND temp_rise_f < 20"),
    ("EFFICIENCY_DEGRADATION", "hydraulic_efficiency_pct < 70"),
]
HEALTHY = "NO_FAULT_DETECTED"
LIFE = [("90+ days", "pump_health_index >= 75"), ("14–90 days", "pump_health_index >= 50"), ("1–14 days", "pump_health_index >= 25")]
LIFE_LEAST = "<24 hours — pull well"
ALARMS = [
    ("L4_SHUTDOWN", f"vibration_severity > 0.71D OR (pump_health_index < 25 AND failure_mode <> '{HEALTHY}')"),
    ("L3_CRITICAL", "pump_health_index < 25 OR temp_rise_f > 45 OR failure_mode IN ('BEARING_FAILURE_RISK', 'SEAL_DEGRADATION')"),
    ("L2_WARNING", "pump_health_index < 50 OR vibration_severity > 0.45D OR failure_mode IN ('IMPELLER_WEAR', 'SCALE_WAX_BUILDUP', 'GAS_INTERFERENCE_CAVITATION', 'MECHANICAL_IMBALANCE_CAVITATION')"),
    ("L1_ADVISORY", "pump_health_index < 75 OR flow_deviation_pct < -10 OR failure_mode = 'EFFICIENCY_DEGRADATION'"),
]


def with_curve(wells: DataFrame, curves: DataFrame | None = None) -> DataFrame:
    """Adds the design point: of the well in curves (well_id and the columns of DESIGN), the common one where it has none. The join is left to the optimiser."""
    if curves is None:
        return wells.select("*", *[F.lit(v).alias(k) for k, v in DESIGN.items()])
    own = curves.select(F.col("well_id"), *[F.col(k).alias(f"__{k}") for k in DESIGN])
    joined = wells.join(own, "well_id", "left")
    return joined.select(*wells.columns, *[F.coalesce(f"__{k}", F.lit(v)).alias(k) for k, v in DESIGN.items()])


def with_curve_as_of(wells: DataFrame, curves: DataFrame) -> DataFrame:
    """Adds the design point that was valid at each reading: of the well's rows in curves (well_id, valid_from in epoch milliseconds, and the columns of DESIGN) the latest that began at or
    before it, the common one where none had. curves is a table; wells may be a stream."""
    until = F.lead("valid_from").over(Window.partitionBy("well_id").orderBy("valid_from"))
    own = curves.filter("valid_from IS NOT NULL").select(F.col("well_id").alias("__well"), "valid_from", until.alias("__until"), *[F.col(k).alias(f"__{k}") for k in DESIGN])
    met = (F.col("well_id") == F.col("__well")) & (F.col("timestamp") >= F.col("valid_from")) & (F.col("__until").isNull() | (F.col("timestamp") < F.col("__until")))
    return wells.join(own, met, "left").select(*wells.columns, *[F.coalesce(f"__{k}", F.lit(v)).alias(k) for k, v in DESIGN.items()])


def pump_features(wells: DataFrame) -> DataFrame:
    """Deviations from the design point, temperature rise, efficiency, gas flag and vibration severity (at most 1, may be negative). Needs the columns of with_curve."""
    first = wells.select(
        "*",
        F.expr("(flow_rate_bpd - design_flow_bpd) / design_flow_bpd * 100").alias("flow_deviation_pct"),
        F.expr("(pressure_psi - design_pressure_psi) / design_pressure_psi * 100").alias("pressure_deviation_pct"),
        F.expr("temperature_f - design_temperature_f").alias("temp_rise_f"),
        F.expr("flow_rate_bpd * pressure_psi / (design_flow_bpd * design_pressure_psi) * 100").alias("hydraulic_efficiency_pct"),
    )
    return first.select(
        "*",
        F.expr("CASE WHEN methane_ppm > 400 AND flow_deviation_pct < -10 THEN 1 ELSE 0 END").alias("gvf_risk_flag"),
        F.expr("least(1.0D, abs(pressure_deviation_pct) / 80.0D + abs(flow_deviation_pct) / 120.0D + temp_rise_f / 80.0D)").alias("vibration_severity"),
    )


def health_index(features: DataFrame) -> DataFrame:
    """The four part scores and their weighted sum, 8 to 100."""
    parts = features.select("*", *[first_match(*rule).alias(name) for name, rule in PHI_PARTS.items()])
    total = " + ".join(f"{name} * {weight}D" for name, weight in WEIGHTS.items())
    return parts.withColumn("pump_health_index", F.expr(total))


def failure_mode(scored: DataFrame) -> DataFrame:
    """The first fault whose signs are there, and the remaining life band."""
    return scored.withColumns({"failure_mode": first_match(MODES, HEALTHY), "rul_estimate": first_match(LIFE, LIFE_LEAST)})


#: Fixed texts.
ACTIONS = {
    "L4_SHUTDOWN": "SHUT DOWN IMMEDIATELY — initiate well pull and full pump inspection",
    "L3_CRITICAL": "Dispatch field team within 4h — confirm failure mode, prepare workover",
    "L2_WARNING": "Schedule inspection within 24h — run vibration survey and fluid analysis",
    "L1_ADVISORY": "Log in CMMS — inspect at next planned maintenance window",
    "NORMAL": "Continue normal monitoring",
}


def alarm_level(diagnosed: DataFrame) -> DataFrame:
    """The alarm level and what to do."""
    leveled = diagnosed.withColumn("pump_alarm_level", first_match(ALARMS, "NORMAL"))
    texts = [(text, f"pump_alarm_level = '{level}'") for level, text in ACTIONS.items() if level != "NORMAL"]
    return leveled.withColumn("recommended_action", first_match(texts, ACTIONS["NORMAL"]))


def judged(curved: DataFrame) -> DataFrame:
    """Health, fault and alarm of running pumps' readings that have a design point."""
    return alarm_level(failure_mode(health_index(pump_features(curved))))


def pump_health(wells: DataFrame, curves: DataFrame | None = None) -> DataFrame:
    """The whole chain over running pumps. Missing measures are filtered first: least() would pass over a null and report the worst vibration."""
    return judged(with_curve(active_pumps(wells), curves))


def maintenance_band() -> Column:
    """Of predictive_maintenance_score."""
    return first_match([("MAINTENANCE_REQUIRED", "predictive_maintenance_score > 70"), ("ELEVATED_WEAR", "predictive_maintenance_score >= 40")], "NO_ACTION")
