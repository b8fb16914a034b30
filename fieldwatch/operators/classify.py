"""Risk classes, quality scores and completeness filters of readings. No shuffle; tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldwatch.functions.rules import decode_base64, first_match

WELL_COLUMNS = ("well_id", "facility_id", "timestamp", "methane_ppm", "co2_ppm", "pressure_psi", "temperature_f", "flow_rate_bpd", "vibration_encoded", "pump_status", "maintenance_alert")
TANK_COLUMNS = ("tank_id", "facility_id", "timestamp", "level_percentage", "vapor_concentration_ppm", "leak_detection_status", "ambient_temperature_f", "internal_pressure_psi", "emergency_shutdown")


def emission_risk(high: float = 500, medium: float = 100) -> Column:
    """Of methane_ppm; null is NORMAL. The compliance profile takes medium=300."""
    return first_match([("HIGH_EMISSION", f"methane_ppm > {high}"), ("MEDIUM_EMISSION", f"methane_ppm > {medium}")], "NORMAL")


def vapor_risk(critical: float = 10000, high: float = 5000) -> Column:
    return first_match([("CRITICAL", f"vapor_concentration_ppm > {critical}"), ("HIGH", f"vapor_concentration_ppm > {high}")], "NORMAL")


def _extra(df: DataFrame) -> list[str]:
    return [c for c in ("event_timestamp", "n") if c in df.columns]


def well_metrics(wells: DataFrame, high: float = 500, medium: float = 100) -> DataFrame:
    """Well readings that have a time, with their emission class."""
    return wells.select(*WELL_COLUMNS, *_extra(wells), emission_risk(high, medium).alias("emission_risk_level")).filter("timestamp IS NOT NULL")


def tank_metrics(tanks: DataFrame) -> DataFrame:
    """Tank readings that have a time, without the columns nothing uses, with their vapour class."""
    return tanks.select(*TANK_COLUMNS, *_extra(tanks), vapor_risk().alias("vapor_risk_level")).filter("timestamp IS NOT NULL")


def _complete(*columns: str) -> Column:
    """All present; a NaN would spoil every later mean, so it counts as missing."""
    numbers = [c for c in columns if not c.endswith("_id")]
    return F.expr(" AND ".join([*(f"{c} IS NOT NULL" for c in columns), *(f"NOT isnan({c})" for c in numbers)]))


def clean_wells(metrics: DataFrame) -> DataFrame:
    """Complete well readings with data_quality_score; the flow isn't asked for."""
    score = first_match([(75, "emission_risk_level = 'HIGH_EMISSION'"), (85, "emission_risk_level = 'MEDIUM_EMISSION'")], 95)
    return metrics.filter(_complete("well_id", "facility_id", "methane_ppm", "co2_ppm", "pressure_psi", "temperature_f")).withColumn("data_quality_score", score)


def clean_tanks(metrics: DataFrame) -> DataFrame:
    """Complete tank readings with data_quality_score."""
    score = first_match([(70, "vapor_risk_level = 'CRITICAL'"), (80, "vapor_risk_level = 'HIGH'")], 95)
    return metrics.filter(_complete("tank_id", "facility_id", "level_percentage", "vapor_concentration_ppm", "internal_pressure_psi")).withColumn("data_quality_score", score)


def active_pumps(wells: DataFrame) -> DataFrame:
    """Readings of running pumps that have flow, pressure and temperature."""
    return wells.filter(F.expr("pump_status = 'active'") & _complete("flow_rate_bpd", "pressure_psi", "temperature_f"))


def with_vibration(wells: DataFrame) -> DataFrame:
    """Adds vibration_decoded."""
    return wells.withColumn("vibration_decoded", decode_base64(F.col("vibration_encoded")))


def compliance_stream(wells: DataFrame) -> DataFrame:
    """The nine declared columns and the compliance profile's emission class."""
    return wells.select("well_id", "facility_id", "timestamp", "methane_ppm", "co2_ppm", "pressure_psi", "flow_rate_bpd", "pump_status", "maintenance_alert", *_extra(wells), emission_risk(500, 300).alias("emission_risk_level"))


def compliance_flag() -> Column:
    """Of methane_ppm."""
    return first_match([("REGULATORY_ACTION_REQUIRED", "methane_ppm > 500")], "COMPLIANT")
