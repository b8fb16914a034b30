"""Declared schemas, as DDL; nothing is inferred."""

WELL = (
    "well_id string, facility_id string, timestamp bigint, methane_ppm double, co2_ppm double, pressure_psi double, temperature_f double, "
    "flow_rate_bpd double, vibration_encoded string, pump_status string, maintenance_alert boolean"
)
TANK = (
    "tank_id string, facility_id string, timestamp bigint, level_percentage double, vapor_concentration_ppm double, leak_detection_status string, "
    "ambient_temperature_f double, internal_pressure_psi double, flame_arrestor_status boolean, vapor_recovery_active boolean, emergency_shutdown boolean, "
    "wind_speed_mph double, atmospheric_pressure_mb double, air_quality_index int"
)
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
"""The driver's event table, from which telemetry is derived."""
