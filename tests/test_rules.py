"""Rules at and beside their bounds."""

import pytest
from pyspark.sql import functions as F

from fieldwatch.functions.rules import decimal_text, decode_base64, first_match, utc_text
from fieldwatch.operators import classify, pump
from fieldwatch.operators.joins import CORRELATION, STATUS


def value(spark, row, column):
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in row.items())).select(column).first()[0]


@pytest.mark.parametrize("ppm, usual, strict", [(500.0, "MEDIUM_EMISSION", "MEDIUM_EMISSION"), (500.01, "HIGH_EMISSION", "HIGH_EMISSION"), (100.0, "NORMAL", "NORMAL"), (100.5, "MEDIUM_EMISSION", "NORMAL"), (300.0, "MEDIUM_EMISSION", "NORMAL"), (300.5, "MEDIUM_EMISSION", "MEDIUM_EMISSION"), (None, "NORMAL", "NORMAL")])
def test_emission(spark, ppm, usual, strict):
    assert value(spark, {"methane_ppm": ppm}, classify.emission_risk()) == usual
    assert value(spark, {"methane_ppm": ppm}, classify.emission_risk(medium=300)) == strict


@pytest.mark.parametrize("ppm, want", [(5000.0, "NORMAL"), (5000.1, "HIGH"), (10000.0, "HIGH"), (10000.1, "CRITICAL"), (None, "NORMAL")])
def test_vapor(spark, ppm, want):
    assert value(spark, {"vapor_concentration_ppm": ppm}, classify.vapor_risk()) == want


@pytest.mark.parametrize("part, column, bounds", [
    ("phi_flow", "flow_deviation_pct", [(-5, 100), (-5.01, 75), (-15, 75), (-15.01, 45), (-30, 45), (-30.01, 20), (-50, 20), (-50.01, 5), (80, 100)]),
    ("phi_pressure", "pressure_deviation_pct", [(-10, 100), (15, 100), (15.01, 75), (-20, 75), (25, 75), (25.01, 45), (-30, 45), (40, 45), (40.01, 15), (-30.01, 15)]),
    ("phi_thermal", "temp_rise_f", [(9.99, 100), (10, 80), (20, 50), (35, 25), (50, 5)]),
    ("phi_vibration", "vibration_severity", [(-1, 100), (0.28, 75), (0.45, 35), (0.71, 5)]),
])
def test_parts(spark, part, column, bounds):
    for x, want in bounds:
        assert value(spark, {column: float(x)}, first_match(*pump.PHI_PARTS[part])) == want, x


@pytest.mark.parametrize("phi, mode, severity, want", [(24.9, "NO_FAULT_DETECTED", 0.1, "L3_CRITICAL"), (24.9, "IMPELLER_WEAR", 0.1, "L4_SHUTDOWN"), (25.0, "NO_FAULT_DETECTED", 0.1, "L2_WARNING"), (50.0, "NO_FAULT_DETECTED", 0.1, "L1_ADVISORY"), (75.0, "NO_FAULT_DETECTED", 0.1, "NORMAL"), (75.0, "NO_FAULT_DETECTED", 0.71, "L2_WARNING"), (75.0, "NO_FAULT_DETECTED", 0.72, "L4_SHUTDOWN"), (80.0, "SEAL_DEGRADATION", 0.1, "L3_CRITICAL"), (80.0, "EFFICIENCY_DEGRADATION", 0.1, "L1_ADVISORY")])
def test_alarms(spark, phi, mode, severity, want):
    row = {"pump_health_index": phi, "failure_mode": mode, "vibration_severity": severity, "temp_rise_f": 0.0, "flow_deviation_pct": 0.0}
    assert value(spark, row, first_match(pump.ALARMS, "NORMAL")) == want


def test_the_first_fault_counts(spark):
    row = {"flow_deviation_pct": -25.0, "pressure_deviation_pct": 25.0, "temp_rise_f": 40.0, "vibration_severity": 0.9, "gvf_risk_flag": 1.0, "hydraulic_efficiency_pct": 10.0}
    mode = first_match(pump.MODES, pump.HEALTHY)
    assert value(spark, row, mode) == "SCALE_WAX_BUILDUP"
    assert value(spark, row | {"pressure_deviation_pct": 0.0}, mode) == "BEARING_FAILURE_RISK"
    seal = row | {"pressure_deviation_pct": 10.0, "flow_deviation_pct": 5.0, "temp_rise_f": 26.0, "vibration_severity": 0.4}
    assert value(spark, seal, mode) == "SEAL_DEGRADATION"
    assert value(spark, seal | {"flow_deviation_pct": 5.1}, mode) == "GAS_INTERFERENCE_CAVITATION"


def test_missing_measures_never_look_like_shutdowns(spark):
    schema = "well_id string, pump_status string, methane_ppm double, flow_rate_bpd double, pressure_psi double, temperature_f double"
    rows = [("a", "active", 1.0, None, 300.0, 90.0), ("b", "active", 1.0, 175.0, float("nan"), 90.0), ("c", "standby", 1.0, 175.0, 300.0, 90.0), ("d", "active", 1.0, 175.0, 300.0, 90.0)]
    got = pump.pump_health(spark.createDataFrame(rows, schema)).collect()
    assert [(r.well_id, r.pump_health_index, r.pump_alarm_level) for r in got] == [("d", 100.0, "NORMAL")]


def test_joined_scores(spark):
    for emission, vapor, correlation, status in [("HIGH_EMISSION", "NORMAL", 95, "CRITICAL_ALERT"), ("MEDIUM_EMISSION", "HIGH", 95, "CRITICAL_ALERT"), ("MEDIUM_EMISSION", "NORMAL", 50, "WARNING"), ("NORMAL", "NORMAL", 50, "NORMAL")]:
        row = {"emission_risk_level": emission, "vapor_risk_level": vapor}
        assert (value(spark, row, first_match(CORRELATION, 50)), value(spark, row, first_match(STATUS, "NORMAL"))) == (correlation, status)


@pytest.mark.parametrize("text, want", [(None, "N/A"), ("", ""), ("dmliXzE=", "vib_1"), ("dmliXzE", "vib_1"), ("dm!li\nXzE=", "vib_1"), ("8J-YgA", "😀"), ("dmliXzEx=junk", "vib_11"), ("dmliA", "vib"), ("/w==", "�")])
def test_base64(spark, text, want):
    assert value(spark, {"x": text} if text is not None else {"x": None}, decode_base64(F.col("x").cast("string"))) == want


def test_texts(spark):
    assert value(spark, {"x": 2.345678}, decimal_text(F.col("x"), 2)) == "2.35"
    assert value(spark, {"x": 1704067200999.0}, utc_text(F.col("x"))) == "2024-01-01 00:00:00"
