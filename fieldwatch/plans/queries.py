"""Registered queries: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.functions.rules import utc_text
from fieldwatch.operators import anomaly, classify, compliance, history, incidents, joins, pump, serving
from fieldwatch.sources import telemetry
from fieldwatch.sources.telemetry import T0
from fieldwatch.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]


def _wells(spark: SparkSession, sf_dir: str, profile: str = "fast") -> DataFrame:
    return telemetry.wells(telemetry.events(spark, sf_dir), profile)


def _tanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.tanks(telemetry.events(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return classify.clean_wells(classify.well_metrics(_wells(spark, sf_dir))), classify.clean_tanks(classify.tank_metrics(_tanks(spark, sf_dir)))


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def well_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)[0]


def tank_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(spark, sf_dir)[1]


def vibration_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.with_vibration(_wells(spark, sf_dir)).select("well_id", "timestamp", "vibration_encoded", "vibration_decoded")


def emission_profile_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.compliance_stream(_wells(spark, sf_dir))


def epa_exceedance_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compliance.epa_exceedances(emission_profile_compliance(spark, sf_dir))


def pump_maintenance_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compliance.maintenance_alerts(_wells(spark, sf_dir))


def _report(spark: SparkSession, sf_dir: str, profile: str = "fast") -> DataFrame:
    return pump.pump_health(classify.well_metrics(_wells(spark, sf_dir, profile)))


def pump_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pump.pump_features(pump.with_curve(classify.active_pumps(_wells(spark, sf_dir))))
    return rows.select("well_id", "timestamp", "flow_deviation_pct", "pressure_deviation_pct", "temp_rise_f", "hydraulic_efficiency_pct", "gvf_risk_flag", "vibration_severity")


def pump_health_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("well_id", "timestamp", "phi_flow", "phi_pressure", "phi_thermal", "phi_vibration", "pump_health_index")


def pump_failure_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("well_id", "timestamp", "failure_mode", "rul_estimate")


def pump_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).select("well_id", "timestamp", "pump_alarm_level", "recommended_action")


def pump_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rounded(_report(spark, sf_dir), "pump_health_index", "flow_deviation_pct", "pressure_deviation_pct", "temp_rise_f", "hydraulic_efficiency_pct", places=4)
    return rows.select("well_id", "facility_id", "timestamp", "pump_health_index", "failure_mode", "rul_estimate", "pump_alarm_level", "flow_deviation_pct", "pressure_deviation_pct", "temp_rise_f", "hydraulic_efficiency_pct")


def _curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A design point of its own for every well but each fifth, derived from the events' wells."""
    number = "cast(substring(well_id, 6) AS int)"
    wells = _wells(spark, sf_dir).select("well_id").distinct().filter(f"{number} % 5 <> 0")
    return wells.selectExpr("well_id", f"150.0D + 2 * {number} AS design_flow_bpd", f"280.0D + {number} AS design_pressure_psi", "88.0D AS design_temperature_f")


def pump_health_by_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pump.pump_health(classify.well_metrics(_wells(spark, sf_dir)), _curves(spark, sf_dir))
    return _rounded(rows, "pump_health_index", places=4).select("well_id", "timestamp", "design_flow_bpd", "pump_health_index", "failure_mode", "pump_alarm_level")


def facility_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.interval_join(*_clean(spark, sf_dir))


def facility_interval_join_5s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.interval_join(*_clean(spark, sf_dir), tolerance_ms=5_000)


def facility_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.status_counts(*_clean(spark, sf_dir))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    wells, tanks = _clean(spark, sf_dir)
    return anomaly.zscores(facility_interval_join(spark, sf_dir), wells=wells, join=lambda rows: joins.interval_join(rows, tanks))


def methane_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_judged(spark, sf_dir), "methane_zscore").select("well_id", "tank_id", "well_ts", "tank_ts", "methane_zscore", "predictive_maintenance_score", "is_anomaly")


def maintenance_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _judged(spark, sf_dir).select("facility_id", pump.maintenance_band().alias("maintenance_band"))
    return rows.groupBy("facility_id", "maintenance_band").agg(F.count("*").alias("n"))


def sensor_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    rows = anomaly.sensor_features(facility_interval_join(spark, sf_dir)).withColumn("v", vector_to_array("sensor_features"))
    return rows.select("well_id", "tank_id", "well_ts", "tank_ts", *[F.col("v")[k].alias(f"f{k}") for k in range(4)])


def facility_health_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(serving.facility_health(_judged(spark, sf_dir)), "methane_zscore")


def facility_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.facility_health(_judged(spark, sf_dir)).select("key", serving.facility_payload().alias("payload"))


def _now(readings: DataFrame) -> int:
    """The newest reading's time: one number, for queries that ask for the present."""
    return readings.agg(F.max("timestamp")).first()[0] or T0


def health_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.lookup(facility_health_latest(spark, sf_dir), None, _now(_wells(spark, sf_dir))).select("key", "risk_score", "facility_status", "expires_at")


def well_realtime_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compliance.well_kpis(_wells(spark, sf_dir)), "avg_methane")


def ldar_hourly_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compliance.ldar_hourly(_wells(spark, sf_dir, "slow")), "avg_methane")


def facility_daily_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compliance.facility_daily(_wells(spark, sf_dir, "slow")), "avg_methane", places=8)


def retained_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    wells = _wells(spark, sf_dir, "slow")
    return compliance.retained(facility_daily_emissions(spark, sf_dir), _now(wells), 7).select("window_start", "facility_id", "reading_count")


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _report(spark, sf_dir, "mixed").withColumnRenamed("timestamp", "ts")
    return rows.select("well_id", "ts", "n", F.col("pump_health_index").alias("phi"), "failure_mode")


def phi_history_last50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(history.with_history(_readings(spark, sf_dir)), "phi_sum", places=3).select("well_id", "ts", "n_history", "first_ts", "phi_sum")


def phi_history_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(history.session_summaries(_readings(spark, sf_dir)), "min_phi", "max_phi", places=3)


def phi_history_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history_length(_readings(spark, sf_dir), _now(_wells(spark, sf_dir, "mixed")))


def phi_history_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("pump:rul:bearing:"), "well_id").alias("key")
    return _readings(spark, sf_dir).select(key, "n", serving.history_entry().alias("entry"))


def phi_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(history.with_history(_readings(spark, sf_dir)), "slope", "intercept", "r2", places=4).select("well_id", "ts", "n_history", "slope", "intercept", "r2")


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.remaining_life(history.with_history(_readings(spark, sf_dir)).filter("failure_mode = 'BEARING_FAILURE_RISK'"))


def rul_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_predictions(spark, sf_dir), "hours_to_critical", places=3).select("well_id", "ts", "n_history", "rul_case", "hours_to_critical", "rul_text")


def _overlaid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.rul_overlay(_report(spark, sf_dir, "mixed"), _predictions(spark, sf_dir))


def rul_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlaid(spark, sf_dir).select("well_id", "timestamp", "pump_alarm_level", "rul", "rul_method")


def _latest_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest alarm of each well first, then the history of its days only."""
    report = _report(spark, sf_dir, "mixed").withColumns({"rul": F.col("rul_estimate"), "rul_method": F.lit("rule_based")})
    return history.overlaid_latest(serving.pump_alarms(report), _readings(spark, sf_dir))


def pump_alarm_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _latest_alarms(spark, sf_dir)
    return _rounded(rows, "pump_health_index", "flow_deviation_pct", "pressure_deviation_pct", "temp_rise_f", places=4)


def pump_alarm_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest_alarms(spark, sf_dir).select("key", serving.alarm_payload().alias("payload"))


def alarm_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.lookup(pump_alarm_latest(spark, sf_dir), "pump:WELL-18:alarm", _now(_wells(spark, sf_dir, "mixed"))).select("key", "pump_alarm_level", "expires_at")


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.anomaly_events(_judged(spark, sf_dir), _report(spark, sf_dir))


def anomaly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rounded(_anomalies(spark, sf_dir), "methane_zscore", "pump_health_index", "temp_rise_f", "flow_deviation_pct", places=4)
    return rows.select("well_id", "well_ts", "facility_id", "methane_zscore", "methane_ppm", "emission_risk_level", "pump_health_index", "pump_alarm_level", "pressure_psi", "temp_rise_f", "flow_deviation_pct")


def anomaly_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _anomalies(spark, sf_dir).select("well_id", "well_ts", anomaly.anomaly_type().alias("anomaly_type"))


def compliance_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wells(spark, sf_dir).select("well_id", "timestamp", classify.compliance_flag().alias("compliance_flag"), utc_text(F.col("timestamp")).alias("stamped_at"))


def incident_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _full_records(spark, sf_dir).drop("well_ts")


def incident_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents.incident_log(_full_records(spark, sf_dir))
    return rows.select("id", "content", F.col("metadata")["severity"].alias("severity"), F.col("metadata")["timestamp"].alias("stamped_at"))


def _similar(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    """Queries: vectors whose id is divisible by 20; corpus: all."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return _rounded(incidents.similar_incidents(vectors.filter("vec_id % 20 = 0"), vectors, threshold=threshold), "cosine")


def similar_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, 0.35)


def similar_incidents_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, 0.70)


def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.interval_join(spark, sf_dir)


def stream_well_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.well_kpis(spark, sf_dir), "avg_methane")


def stream_ldar_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.ldar_hourly(spark, sf_dir), "avg_methane")


def stream_facility_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.facility_daily(spark, sf_dir), "avg_methane", places=8)


def stream_pump_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.pump_alarms(spark, sf_dir), "pump_health_index", places=4)


def stream_methane_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.methane_zscore(spark, sf_dir), "methane_zscore")


def stream_facility_health_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.facility_health(spark, sf_dir), "methane_zscore")


def stream_phi_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rounded(_rounded(streams.phi_history(spark, sf_dir), "phi_sum", places=3), "slope", "intercept", "r2", places=4)
    return rows.select("well_id", "ts", "n_history", "first_ts", "phi_sum", "slope", "intercept", "r2")


def stream_pump_alarm_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.pump_alarm_latest(spark, sf_dir), "pump_health_index", "flow_deviation_pct", "pressure_deviation_pct", "temp_rise_f", places=4)


def stream_kpi_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.kpi_changes(spark, sf_dir), "avg_methane")


def stream_served_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.both_served(spark, sf_dir)


def kept_alarm_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = streams.kept_alarm(spark, sf_dir, "WELL-18", _now(_wells(spark, sf_dir, "mixed")))
    return rows.select("key", "ts", "pump_alarm_level", "rul", "rul_method", "expires_at")


def _dated_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three design points one after another for every well but each fifth, derived from the events' wells: from the start, and after each third of a quarter of an hour."""
    wells = _curves(spark, sf_dir).withColumn("turn", F.explode(F.expr("sequence(0L, 2L)")))
    return wells.select("well_id", (F.lit(T0) + F.col("turn") * 300_000).alias("valid_from"), (F.col("design_flow_bpd") + 10 * F.col("turn")).alias("design_flow_bpd"), "design_pressure_psi", "design_temperature_f")


def stream_pump_health_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(streams.health_as_of(spark, sf_dir, _dated_curves(spark, sf_dir)), "pump_health_index", places=4)


def stream_anomaly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rounded(streams.anomaly_events(spark, sf_dir), "methane_zscore", "pump_health_index", "temp_rise_f", "flow_deviation_pct", places=4)
    return rows.select("well_id", "well_ts", "facility_id", "methane_zscore", "methane_ppm", "emission_risk_level", "pump_health_index", "pump_alarm_level", "pressure_psi", "temp_rise_f", "flow_deviation_pct")


def phi_trend_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest trend of each pump from its kept JSON entries, among which every 97th stands once more, cut off; those are set aside."""
    entries = phi_history_entries(spark, sf_dir)
    cut = entries.filter("n % 97 = 0").withColumn("entry", F.expr("substring(entry, 1, length(entry) - 3)"))
    good, _ = history.parsed_entries(entries.unionByName(cut))
    return _rounded(history.fitted_entries(good), "slope", "intercept", "r2", places=4)


def _full_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _report(spark, sf_dir)
    readings = report.select("well_id", F.col("timestamp").alias("ts"), "n", F.col("pump_health_index").alias("phi"), "failure_mode")
    lives = history.remaining_life(history.with_history(readings).filter("failure_mode = 'BEARING_FAILURE_RISK'"))
    return incidents.full_records(_anomalies(spark, sf_dir), history.rul_overlay(report, lives))


def incident_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.incident_texts(_full_records(spark, sf_dir)).select("well_id", "well_ts", "estimated_rul", "content", "id", "generated_at")


def incident_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents are logged twice, as a repeated batch would, and every anomaly asks the log for the three most alike."""
    rows = incidents.incident_texts(_full_records(spark, sf_dir)).withColumn("question", incidents.question_of())
    kept = streams.logged_incidents(rows, repeats=2)
    asked = kept.select("well_id", "well_ts", "question")
    return asked.join(incidents.retrieve(asked, kept.select("id", "content")), "question").select("well_id", "well_ts", "rank", "id", "cosine")


def retained_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows kept by date, of which those that ended a week before the newest reading are dropped as whole dates."""
    now = _now(_wells(spark, sf_dir, "slow"))
    return streams.retained_windows(facility_daily_emissions(spark, sf_dir), now, 7).select("window_start", "facility_id", "reading_count")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        well_classified, tank_classified, vibration_decoded, emission_profile_compliance, epa_exceedance_alerts, pump_maintenance_alerts, pump_features, pump_health_index, pump_failure_mode,
        pump_alarms, pump_summary, pump_health_by_asset, facility_interval_join, facility_interval_join_5s, facility_status_counts, methane_zscore, maintenance_band, sensor_features,
        facility_health_latest, facility_payloads, health_lookup, well_realtime_kpis, ldar_hourly_compliance, facility_daily_emissions, retained_compliance, phi_history_last50,
        phi_history_sessions, phi_history_length, phi_history_entries, phi_trend, rul_prediction, rul_overlay, pump_alarm_latest, pump_alarm_payloads, alarm_lookup, anomaly_events,
        anomaly_types, compliance_flags, incident_records, incident_log, similar_incidents, similar_incidents_strict, stream_interval_join, stream_well_kpis, stream_ldar_hourly,
        stream_facility_daily, stream_pump_alarms, stream_methane_zscore, stream_facility_health_latest, stream_phi_history, stream_pump_alarm_latest, stream_kpi_changes, stream_served_keys,
        kept_alarm_lookup, stream_pump_health_as_of, stream_anomaly_events, phi_trend_parsed, incident_texts, incident_retrieval, retained_windows,
    )
}
