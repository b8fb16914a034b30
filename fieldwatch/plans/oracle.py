"""SQL for DuckDB with the same rows as the registered queries, written apart from the operators."""

from __future__ import annotations

T0 = 1704067200000
TIMES = {
    "fast": f"{T0} + n * 1000 + (u * {{0}}) % 1000",
    "mixed": f"{T0} + n * 1000 + (u * {{0}}) % 1000 + (n // 4000) * 3700000",
    "slow": "epoch_us(ts) // 1000",
}
#: The SQL of the derived feeds and of the steps that several queries share, each a common table expression.
EV = "ev AS (SELECT event_id AS n, user_id AS u, ts FROM events)"


def _num(low: int, a: int, b: int, size: int) -> str:
    return f"{low} + ((n * {a} + u * {b}) % {size}) / 100.0e0"


def _wells(profile: str = "fast") -> str:
    return f"""{EV}, w AS (SELECT 'WELL-' || (n % 20 + 1) AS well_id, 'FAC-' || (n % 10 + 1) AS facility_id, ({TIMES[profile].format(7919)})::BIGINT AS timestamp,
  {_num(5, 7919, 104729, 79501)} AS methane_ppm, {_num(10, 6101, 15485863, 99001)} AS co2_ppm,
  CASE WHEN n % 20 = 17 THEN 300.0e0 ELSE {_num(100, 7927, 49979, 40001)} END AS pressure_psi,
  CASE WHEN n % 20 = 17 THEN 112.0e0 + (n % 2000) / 100.0e0 ELSE {_num(50, 4447, 32452843, 8001)} END AS temperature_f,
  CASE WHEN n % 20 = 17 THEN 160.0e0 - (n % 4000) / 100.0e0 WHEN n % 20 = 3 THEN 170.0e0 ELSE {_num(50, 3571, 86028121, 25001)} END AS flow_rate_bpd,
  to_base64(encode('vib_' || n)) AS vibration_encoded, CASE (n + u) % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'inactive' ELSE 'standby' END AS pump_status, u % 7 = 0 AS maintenance_alert, n FROM ev)"""


TANKS = f"""t AS (SELECT 'TANK-' || (n % 15 + 1) AS tank_id, 'FAC-' || (n % 10 + 1) AS facility_id, ({TIMES["fast"].format(6101)})::BIGINT AS timestamp,
  {_num(5, 7919, 224737, 9001)} AS level_percentage, {_num(100, 15485867, 1299709, 1490001)} AS vapor_concentration_ppm,
  CASE (n + u) % 3 WHEN 0 THEN 'NORMAL' WHEN 1 THEN 'LEAK_DETECTED' ELSE 'CRITICAL' END AS leak_detection_status,
  {_num(40, 6113, 7057, 7001)} AS ambient_temperature_f, {_num(5, 5507, 9041, 4501)} AS internal_pressure_psi, u % 11 = 0 AS emergency_shutdown, n FROM ev)"""
RISK = "CASE WHEN methane_ppm > 500 THEN 'HIGH_EMISSION' WHEN methane_ppm > 100 THEN 'MEDIUM_EMISSION' ELSE 'NORMAL' END"
VAPOR = "CASE WHEN vapor_concentration_ppm > 10000 THEN 'CRITICAL' WHEN vapor_concentration_ppm > 5000 THEN 'HIGH' ELSE 'NORMAL' END"
WC = f"wc AS (SELECT *, {RISK} AS emission_risk_level, CASE WHEN methane_ppm > 500 THEN 75 WHEN methane_ppm > 100 THEN 85 ELSE 95 END AS data_quality_score FROM w)"
TC = f"tc AS (SELECT *, {VAPOR} AS vapor_risk_level, CASE WHEN vapor_concentration_ppm > 10000 THEN 70 WHEN vapor_concentration_ppm > 5000 THEN 80 ELSE 95 END AS data_quality_score FROM t)"
COMPLIANCE = "CASE WHEN methane_ppm > 500 THEN 'HIGH_EMISSION' WHEN methane_ppm > 300 THEN 'MEDIUM_EMISSION' ELSE 'NORMAL' END"


def _utc(ms: str) -> str:
    return f"strftime(make_timestamp(({ms} // 1000) * 1000000), '%Y-%m-%d %H:%M:%S')"


def _text(x: str, places: int) -> str:
    return f"CAST(round({x}, {places}) AS DECIMAL(18, {places}))::VARCHAR"


def _pump(profile: str = "fast", flow: str = "175.0e0", pressure: str = "300.0e0", heat: str = "90.0e0", extra: str = "") -> str:
    """Feeds, then f (deviations), g (severity), h (index), m (mode) and a (alarm)."""
    return f"""{_wells(profile)}, {WC}{extra}, f AS (SELECT *, (flow_rate_bpd - {flow}) / {flow} * 100 AS flow_deviation_pct, (pressure_psi - {pressure}) / {pressure} * 100 AS pressure_deviation_pct,
  temperature_f - {heat} AS temp_rise_f, flow_rate_bpd * pressure_psi / ({flow} * {pressure}) * 100 AS hydraulic_efficiency_pct FROM {"wc" if not extra else "wx"} WHERE pump_status = 'active'),
g AS (SELECT *, CASE WHEN methane_ppm > 400 AND flow_deviation_pct < -10 THEN 1 ELSE 0 END AS gvf_risk_flag,
  least(1.0e0, abs(pressure_deviation_pct) / 80.0e0 + abs(flow_deviation_pct) / 120.0e0 + temp_rise_f / 80.0e0) AS vibration_severity FROM f),
p AS (SELECT *, CASE WHEN flow_deviation_pct >= -5 THEN 100.0e0 WHEN flow_deviation_pct >= -15 THEN 75.0e0 WHEN flow_deviation_pct >= -30 THEN 45.0e0 WHEN flow_deviation_pct >= -50 THEN 20.0e0 ELSE 5.0e0 END AS phi_flow,
  CASE WHEN pressure_deviation_pct BETWEEN -10 AND 15 THEN 100.0e0 WHEN pressure_deviation_pct BETWEEN -20 AND 25 THEN 75.0e0 WHEN pressure_deviation_pct BETWEEN -30 AND 40 THEN 45.0e0 ELSE 15.0e0 END AS phi_pressure,
  CASE WHEN temp_rise_f < 10 THEN 100.0e0 WHEN temp_rise_f < 20 THEN 80.0e0 WHEN temp_rise_f < 35 THEN 50.0e0 WHEN temp_rise_f < 50 THEN 25.0e0 ELSE 5.0e0 END AS phi_thermal,
  CASE WHEN vibration_severity < 0.28e0 THEN 100.0e0 WHEN vibration_severity < 0.45e0 THEN 75.0e0 WHEN vibration_severity < 0.71e0 THEN 35.0e0 ELSE 5.0e0 END AS phi_vibration FROM g),
h AS (SELECT *, phi_flow * 0.4e0 + phi_pressure * 0.3e0 + phi_thermal * 0.2e0 + phi_vibration * 0.1e0 AS pump_health_index FROM p),
m AS (SELECT *, CASE WHEN flow_deviation_pct < -15 AND pressure_deviation_pct > 20 THEN 'SCALE_WAX_BUILDUP' WHEN flow_deviation_pct < -20 AND pressure_deviation_pct < -15 THEN 'IMPELLER_WEAR'
  WHEN temp_rise_f > 30 AND vibration_severity > 0.45e0 THEN 'BEARING_FAILURE_RISK'
  WHEN temp_rise_f > 25 AND flow_deviation_pct BETWEEN -10 AND 5 AND pressure_deviation_pct BETWEEN -10 AND 10 THEN 'SEAL_DEGRADATION' WHEN gvf_risk_flag = 1 THEN 'GAS_INTERFERENCE_CAVITATION'
  WHEN vibration_severity > 0.45e0 AND temp_rise_f < 20 THEN 'MECHANICAL_IMBALANCE_CAVITATION' WHEN hydraulic_efficiency_pct < 70 THEN 'EFFICIENCY_DEGRADATION' ELSE 'NO_FAULT_DETECTED' END AS failure_mode,
  CASE WHEN pump_health_index >= 75 THEN '90+ days' WHEN pump_health_index >= 50 THEN '14–90 days' WHEN pump_health_index >= 25 THEN '1–14 days' ELSE '<24 hours — pull well' END AS rul_estimate FROM h),
a0 AS (SELECT *, CASE WHEN vibration_severity > 0.71e0 OR (pump_health_index < 25 AND failure_mode <> 'NO_FAULT_DETECTED') THEN 'L4_SHUTDOWN'
  WHEN pump_health_index < 25 OR temp_rise_f > 45 OR failure_mode IN ('BEARING_FAILURE_RISK', 'SEAL_DEGRADATION') THEN 'L3_CRITICAL'
  WHEN pump_health_index < 50 OR vibration_severity > 0.45e0 OR failure_mode IN ('IMPELLER_WEAR', 'SCALE_WAX_BUILDUP', 'GAS_INTERFERENCE_CAVITATION', 'MECHANICAL_IMBALANCE_CAVITATION') THEN 'L2_WARNING'
  WHEN pump_health_index < 75 OR flow_deviation_pct < -10 OR failure_mode = 'EFFICIENCY_DEGRADATION' THEN 'L1_ADVISORY' ELSE 'NORMAL' END AS pump_alarm_level FROM m),
a AS (SELECT *, CASE pump_alarm_level WHEN 'L4_SHUTDOWN' THEN 'SHUT DOWN IMMEDIATELY — initiate well pull and full pump inspection' WHEN 'L3_CRITICAL' THEN 'Dispatch field team within 4h — confirm failure mode, prepare workover'
  WHEN 'L2_WARNING' THEN 'Schedule inspection within 24h — run vibration survey and fluid analysis' WHEN 'L1_ADVISORY' THEN 'Log in CMMS — inspect at next planned maintenance window' ELSE 'Continue normal monitoring' END AS recommended_action FROM a0)"""


def _joined(ms: int = 60000) -> str:
    bad = "wc.emission_risk_level = 'HIGH_EMISSION' OR tc.vapor_risk_level <> 'NORMAL'"
    return f"""{_wells()}, {WC}, {TANKS}, {TC}, j AS (SELECT well_id, wc.facility_id, wc.timestamp AS well_ts, methane_ppm, co2_ppm, emission_risk_level, wc.data_quality_score AS well_data_quality,
  tank_id, tc.timestamp AS tank_ts, level_percentage, vapor_concentration_ppm, vapor_risk_level, tc.data_quality_score AS tank_data_quality,
  CASE WHEN {bad} THEN 95 ELSE 50 END AS correlation_score, CASE WHEN {bad} THEN 'CRITICAL_ALERT' WHEN emission_risk_level = 'MEDIUM_EMISSION' THEN 'WARNING' ELSE 'NORMAL' END AS facility_status,
  (CASE emission_risk_level WHEN 'HIGH_EMISSION' THEN 40 WHEN 'MEDIUM_EMISSION' THEN 20 ELSE 10 END) + (CASE vapor_risk_level WHEN 'CRITICAL' THEN 40 WHEN 'HIGH' THEN 20 ELSE 10 END) AS risk_score
  FROM wc JOIN tc ON wc.facility_id = tc.facility_id AND tc.timestamp BETWEEN wc.timestamp - {ms} AND wc.timestamp + {ms})"""


Z = """s AS (SELECT well_ts // 5000 AS bucket, avg(methane_ppm) AS mean, stddev_samp(methane_ppm) AS sd FROM j GROUP BY 1),
z AS (SELECT j.*, (methane_ppm - coalesce(mean, 200.0e0)) / coalesce(nullif(sd, 0), 1.0e0) AS methane_zscore,
  (CASE emission_risk_level WHEN 'HIGH_EMISSION' THEN 40 WHEN 'MEDIUM_EMISSION' THEN 20 ELSE 0 END) + (CASE vapor_risk_level WHEN 'CRITICAL' THEN 40 WHEN 'HIGH' THEN 20 ELSE 0 END)
    + (CASE WHEN level_percentage > 90 OR level_percentage < 10 THEN 20 ELSE 0 END) AS predictive_maintenance_score FROM j JOIN s ON j.well_ts // 5000 = s.bucket),
zz AS (SELECT *, abs(methane_zscore) > 2.0e0 OR risk_score > 60 AS is_anomaly FROM z)"""
HEALTH = """hl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY facility_id ORDER BY well_ts DESC, tank_ts DESC, well_id DESC, tank_id DESC) AS k FROM zz WHERE is_anomaly) WHERE k = 1)"""


def _windows(profile: str, key: str, size: int, least: bool) -> str:
    return f"""WITH {_wells(profile)} SELECT (timestamp // {size}) * {size} AS window_start, {key}, round(avg(methane_ppm), 6) AS avg_methane, max(methane_ppm) AS max_methane,
  {"min(methane_ppm) AS min_methane, " if least else ""}count(*) AS reading_count, (timestamp // {size}) * {size} + {size} AS window_end FROM w GROUP BY timestamp // {size}, {key}"""


#: Eight places: means of a power of two of readings with two decimals end in ...5 at six.
DAILY = f"""WITH {_wells("slow")} SELECT (timestamp // 86400000) * 86400000 AS window_start, facility_id, round(avg(methane_ppm), 8) AS avg_methane, max(methane_ppm) AS max_methane, count(*) AS reading_count,
  count(DISTINCT well_id) AS well_count, (timestamp // 86400000) * 86400000 + 86400000 AS window_end FROM w GROUP BY timestamp // 86400000, facility_id"""
HISTORY = f"""{_pump("mixed")}, r AS (SELECT well_id, timestamp AS ts, n, pump_health_index AS phi, failure_mode FROM a),
gp AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY well_id ORDER BY ts, n) < 3600000 THEN 0 ELSE 1 END AS gap FROM r),
se AS (SELECT *, (sum(gap) OVER (PARTITION BY well_id ORDER BY ts, n))::BIGINT AS session, (ts - {T0}) / 3600000.0e0 AS x FROM gp),
fr AS (SELECT *, count(*) OVER f AS n_history, first_value(ts) OVER f AS first_ts, sum(phi) OVER f AS phi_sum, max(phi) OVER f - min(phi) OVER f AS spread,
  regr_slope(phi, x) OVER f AS s0, regr_intercept(phi, x) OVER f AS i0, regr_r2(phi, x) OVER f AS q0 FROM se
  WINDOW f AS (PARTITION BY well_id, session ORDER BY ts, n ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)),
tr AS (SELECT *, CASE WHEN spread = 0 OR first_ts = ts THEN 0.0e0 ELSE round(s0, 9) END AS slope, CASE WHEN spread = 0 OR first_ts = ts THEN phi_sum / n_history ELSE i0 + s0 * (first_ts - {T0}) / 3600000.0e0 END AS intercept,
  CASE WHEN spread <> 0 AND first_ts <> ts THEN q0 END AS r2 FROM fr)"""
LIFE = f"""{HISTORY}, b AS (SELECT *, CASE WHEN n_history >= 5 AND slope < 0 THEN (25.0e0 - intercept) / slope - ((ts // 10000 + 1) * 10000 - first_ts) / 3600000.0e0 END AS h FROM tr WHERE failure_mode = 'BEARING_FAILURE_RISK'),
c AS (SELECT *, CASE WHEN n_history < 5 THEN 'COLLECTING' WHEN slope >= 0 THEN 'STABLE' WHEN h <= 0 THEN 'OVERDUE' WHEN h < 1 THEN 'MINUTES' WHEN h < 48 THEN 'HOURS' ELSE 'DAYS' END AS rul_case,
  {_text("slope", 3)} AS st, coalesce({_text("r2", 2)}, 'NaN') AS rt FROM b),
l AS (SELECT *, CASE rul_case WHEN 'COLLECTING' THEN 'collecting history (' || n_history || '/5 readings)' WHEN 'STABLE' THEN 'stable or improving (slope=+' || st || ' PHI/hr, R²=' || rt || ')'
  WHEN 'OVERDUE' THEN 'OVERDUE — model projected PHI critical ' || {_text("-h", 1)} || ' hrs ago (R²=' || rt || ', slope=' || st || ' PHI/hr)'
  ELSE '~' || CASE rul_case WHEN 'MINUTES' THEN {_text("h * 60", 0)} || ' min' WHEN 'HOURS' THEN {_text("h", 1)} || ' hrs' ELSE {_text("h / 24", 1)} || ' days' END
    || ' to critical (LinearRegression: slope=' || st || ' PHI/hr, R²=' || rt || ', n=' || n_history || ')' END AS rul_text FROM c)"""
OVERLAY = f"""{LIFE}, lb AS (SELECT well_id, ts // 10000 AS batch, rul_text FROM (SELECT *, row_number() OVER (PARTITION BY well_id, ts // 10000 ORDER BY ts DESC, n DESC) AS k FROM l) WHERE k = 1),
o AS (SELECT a.*, coalesce(lb.rul_text, rul_estimate) AS rul, CASE WHEN lb.rul_text IS NULL THEN 'rule_based' ELSE 'linear_regression' END AS rul_method FROM a LEFT JOIN lb ON a.well_id = lb.well_id AND a.timestamp // 10000 = lb.batch),
al AS (SELECT *, timestamp AS ts, 'pump:' || well_id || ':alarm' AS key, timestamp + 600000 AS expires_at FROM (
  SELECT *, row_number() OVER (PARTITION BY well_id ORDER BY timestamp DESC, n DESC) AS k FROM o WHERE pump_alarm_level IN ('L4_SHUTDOWN', 'L3_CRITICAL', 'L2_WARNING')) WHERE k = 1)"""
EVENTS = f"""{_joined()}, {Z}, {_pump().split(WC + ", ", 1)[1]}, en AS (SELECT well_id, well_ts, max(methane_zscore) AS methane_zscore FROM zz WHERE is_anomaly GROUP BY 1, 2),
e AS (SELECT a.*, en.well_ts, en.methane_zscore FROM en JOIN a ON en.well_id = a.well_id AND en.well_ts = a.timestamp),
ty AS (SELECT *, CASE WHEN flow_deviation_pct < -15 AND (pressure_psi - 300) / 300 * 100 > 20 THEN 'SCALE_WAX_BUILDUP' WHEN temp_rise_f > 30 THEN 'BEARING_DEGRADATION'
  WHEN temp_rise_f > 25 AND flow_deviation_pct BETWEEN -10 AND 5 AND (pressure_psi - 300) / 300 * 100 BETWEEN -10 AND 10 THEN 'SEAL_FAILURE' WHEN methane_ppm > 400 AND flow_deviation_pct < -10 THEN 'GAS_INTERFERENCE_CAVITATION'
  WHEN methane_zscore > 3.5e0 OR methane_ppm > 500 THEN 'EMISSION_EXCEEDANCE' WHEN flow_deviation_pct < -20 AND (pressure_psi - 300) / 300 * 100 < -15 THEN 'MECHANICAL_FAILURE' ELSE 'NORMAL_VARIANCE' END AS anomaly_type FROM e)"""
WELL_LIST = "well_id, facility_id, timestamp, methane_ppm, co2_ppm, pressure_psi, temperature_f, flow_rate_bpd, vibration_encoded, pump_status, maintenance_alert"
JOINED_LIST = "well_id, facility_id, well_ts, methane_ppm, co2_ppm, emission_risk_level, well_data_quality, tank_id, tank_ts, level_percentage, vapor_concentration_ppm, vapor_risk_level, tank_data_quality, correlation_score, facility_status, risk_score"
HEALTH_LIST = "facility_id, well_ts, tank_ts, well_id, tank_id, risk_score, facility_status, round(methane_zscore, 6) AS methane_zscore, predictive_maintenance_score, 'facility:' || facility_id || ':health' AS key, well_ts + 300000 AS expires_at"
CURVES = """, wx AS (SELECT *, CASE WHEN k % 5 <> 0 THEN 150.0e0 + 2 * k ELSE 175.0e0 END AS design_flow_bpd, CASE WHEN k % 5 <> 0 THEN 280.0e0 + k ELSE 300.0e0 END AS design_pressure_psi,
  CASE WHEN k % 5 <> 0 THEN 88.0e0 ELSE 90.0e0 END AS design_temperature_f FROM (SELECT *, well_id[6:]::INT AS k FROM wc))"""


def _similar(threshold: float) -> str:
    return f"""WITH c AS (SELECT q.vec_id AS query_id, d.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS cosine FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id)::INT AS rank FROM c WHERE cosine >= {threshold}e0) SELECT query_id, vec_id, round(cosine, 6) AS cosine, rank FROM r WHERE rank <= 3"""


#: What a stream has closed: joined readings whose window is over for both feeds, and readings of running pumps older than the watermark.
CLOSED_PAIRS = "(well_ts // 5000) * 5000 + 5000 <= least((SELECT max(timestamp) FROM w), (SELECT max(timestamp) FROM t)) - 70000"
#: The pump reports have a watermark of their own, and the least of all counts.
CLOSED_EVENTS = CLOSED_PAIRS.replace("FROM t))", "FROM t), (SELECT max(timestamp) FROM a))")
CLOSED_PUMPS = "ts < (SELECT max(ts) - 10000 FROM r)"
HEALTH_CLOSED = HEALTH.replace("WHERE is_anomaly", f"WHERE is_anomaly AND {CLOSED_PAIRS}")
OVERLAY_CLOSED = OVERLAY.replace("FROM l)", f"FROM l WHERE {CLOSED_PUMPS})").replace("FROM o WHERE", f"FROM o WHERE timestamp < (SELECT max(ts) - 10000 FROM r) AND")
ALARM_LIST = "well_id, ts, n, pump_alarm_level, failure_mode, round(pump_health_index, 4) AS pump_health_index, rul, rul_method, round(flow_deviation_pct, 4) AS flow_deviation_pct, round(pressure_deviation_pct, 4) AS pressure_deviation_pct, round(temp_rise_f, 4) AS temp_rise_f, key, expires_at"
EVENT_LIST = "well_id, well_ts, facility_id, round(methane_zscore, 4) AS methane_zscore, methane_ppm, emission_risk_level, round(pump_health_index, 4) AS pump_health_index, pump_alarm_level, pressure_psi, round(temp_rise_f, 4) AS temp_rise_f, round(flow_deviation_pct, 4) AS flow_deviation_pct"
DATED_CURVES = f""", cv AS (SELECT 'WELL-' || k AS cv_well, {T0} + turn * 300000 AS valid_from, 150.0e0 + 2 * k + 10 * turn AS cv_flow, 280.0e0 + k AS cv_pressure FROM (SELECT DISTINCT well_id[6:]::INT AS k FROM wc), range(3) AS r(turn) WHERE k % 5 <> 0),
wx AS (SELECT wc.*, coalesce(cv_flow, 175.0e0) AS design_flow_bpd, coalesce(cv_pressure, 300.0e0) AS design_pressure_psi, CASE WHEN cv_flow IS NULL THEN 90.0e0 ELSE 88.0e0 END AS design_temperature_f
  FROM wc ASOF LEFT JOIN cv ON wc.well_id = cv.cv_well AND wc.timestamp >= cv.valid_from)"""


#: The overlay's steps over the readings that anomalies have, and the incidents with their remaining life.
FULL = f"""{EVENTS}{OVERLAY.replace(_pump("mixed"), "")}, fu AS (SELECT ty.well_id, ty.well_ts, ty.facility_id, anomaly_type, ty.failure_mode AS root_cause, NULL::VARCHAR AS affected_component,
  CASE WHEN ty.methane_ppm > 500 THEN 'REGULATORY_ACTION_REQUIRED' ELSE 'COMPLIANT' END AS compliance_flag, ty.recommended_action AS immediate_action, o.rul AS estimated_rul, {_utc("ty.well_ts")} AS generated_at,
  CASE ty.pump_alarm_level WHEN 'L4_SHUTDOWN' THEN 1.0e0 WHEN 'L3_CRITICAL' THEN 0.75e0 WHEN 'L2_WARNING' THEN 0.5e0 WHEN 'L1_ADVISORY' THEN 0.25e0 ELSE 0.0e0 END AS severity
  FROM ty JOIN o ON o.well_id = ty.well_id AND o.timestamp = ty.well_ts),
tx AS (SELECT *, 'Well: ' || well_id || ' | Facility: ' || facility_id || ' | Type: ' || anomaly_type || ' | Component: null | Cause: ' || root_cause || ' | Action: ' || immediate_action || ' | RUL: ' || estimated_rul || ' | Severity: ' || {_text("severity", 2)} AS content,
  anomaly_type || ' ' || root_cause || ' ' || immediate_action AS question FROM fu),
tid AS (SELECT *, sha256(content || '@' || generated_at) AS id FROM tx)"""


def _dims(source: str, key: str, text: str) -> str:
    return f"SELECT {key}, ('0x' || md5(w)[1:5])::BIGINT AS dim, count(*) AS tf FROM (SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^a-z0-9_]+')) AS w FROM {source}) WHERE w <> '' GROUP BY ALL"


RETRIEVAL = f"""{FULL}, qs AS (SELECT DISTINCT question FROM tid), dt AS ({_dims("tid", "id", "content")}), qt AS ({_dims("qs", "question", "question")}),
wt AS (SELECT dim, ln((SELECT count(*) FROM tid) / count(*)) AS idf FROM dt GROUP BY dim), dv AS (SELECT id, dim, tf * idf AS v FROM dt JOIN wt USING (dim)), qv AS (SELECT question, dim, tf * idf AS v FROM qt JOIN wt USING (dim)),
cs AS (SELECT question, id, round(sum(q.v * d.v) / (any_value(qn.s) * any_value(dn.s)), 6) AS cosine FROM qv q JOIN dv d USING (dim) JOIN (SELECT question, sqrt(sum(v * v)) AS s FROM qv GROUP BY 1) qn USING (question)
  JOIN (SELECT id, sqrt(sum(v * v)) AS s FROM dv GROUP BY 1) dn USING (id) WHERE q.v > 0 GROUP BY question, id),
rk AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY cosine DESC, id)::INT AS rank FROM cs)"""


SQL: dict[str, str] = {
    "well_classified": f"WITH {_wells()}, {WC} SELECT {WELL_LIST}, n, emission_risk_level, data_quality_score FROM wc",
    "tank_classified": f"WITH {EV}, {TANKS}, {TC} SELECT * FROM tc",
    "vibration_decoded": f"WITH {_wells()} SELECT well_id, timestamp, vibration_encoded, 'vib_' || n AS vibration_decoded FROM w",
    "emission_profile_compliance": f"WITH {_wells()} SELECT well_id, facility_id, timestamp, methane_ppm, co2_ppm, pressure_psi, flow_rate_bpd, pump_status, maintenance_alert, n, {COMPLIANCE} AS emission_risk_level FROM w",
    "epa_exceedance_alerts": f"WITH {_wells()} SELECT well_id, facility_id, methane_ppm, {COMPLIANCE} AS emission_risk_level, 'EPA_40CFR60_OOOOa' AS regulation_code, 'LDAR_INSPECTION_REQUIRED' AS required_action, {_utc('timestamp')} AS detected_at FROM w WHERE methane_ppm > 500",
    "pump_maintenance_alerts": f"WITH {_wells()} SELECT well_id, facility_id, pump_status, pressure_psi, flow_rate_bpd, {_utc('timestamp')} AS flagged_at FROM w WHERE maintenance_alert",
    "pump_features": f"WITH {_pump()} SELECT well_id, timestamp, flow_deviation_pct, pressure_deviation_pct, temp_rise_f, hydraulic_efficiency_pct, gvf_risk_flag, vibration_severity FROM g",
    "pump_health_index": f"WITH {_pump()} SELECT well_id, timestamp, phi_flow, phi_pressure, phi_thermal, phi_vibration, pump_health_index FROM h",
    "pump_failure_mode": f"WITH {_pump()} SELECT well_id, timestamp, failure_mode, rul_estimate FROM m",
    "pump_alarms": f"WITH {_pump()} SELECT well_id, timestamp, pump_alarm_level, recommended_action FROM a",
    "pump_summary": f"WITH {_pump()} SELECT well_id, facility_id, timestamp, round(pump_health_index, 4) AS pump_health_index, failure_mode, rul_estimate, pump_alarm_level, round(flow_deviation_pct, 4) AS flow_deviation_pct, round(pressure_deviation_pct, 4) AS pressure_deviation_pct, round(temp_rise_f, 4) AS temp_rise_f, round(hydraulic_efficiency_pct, 4) AS hydraulic_efficiency_pct FROM a",
    "pump_health_by_asset": f"WITH {_pump('fast', 'design_flow_bpd', 'design_pressure_psi', 'design_temperature_f', CURVES)} SELECT well_id, timestamp, design_flow_bpd, round(pump_health_index, 4) AS pump_health_index, failure_mode, pump_alarm_level FROM a",
    "facility_interval_join": f"WITH {_joined()} SELECT {JOINED_LIST} FROM j",
    "facility_interval_join_5s": f"WITH {_joined(5000)} SELECT {JOINED_LIST} FROM j",
    "facility_status_counts": f"WITH {_joined()} SELECT facility_id, facility_status, risk_score, count(*) AS n_pairs FROM j GROUP BY ALL",
    "methane_zscore": f"WITH {_joined()}, {Z} SELECT well_id, tank_id, well_ts, tank_ts, round(methane_zscore, 6) AS methane_zscore, predictive_maintenance_score, is_anomaly FROM zz",
    "maintenance_band": f"WITH {_joined()}, {Z} SELECT facility_id, CASE WHEN predictive_maintenance_score > 70 THEN 'MAINTENANCE_REQUIRED' WHEN predictive_maintenance_score >= 40 THEN 'ELEVATED_WEAR' ELSE 'NO_ACTION' END AS maintenance_band, count(*) AS n FROM zz GROUP BY ALL",
    "sensor_features": f"WITH {_joined()} SELECT well_id, tank_id, well_ts, tank_ts, methane_ppm AS f0, co2_ppm AS f1, vapor_concentration_ppm AS f2, level_percentage AS f3 FROM j",
    "facility_health_latest": f"WITH {_joined()}, {Z}, {HEALTH} SELECT {HEALTH_LIST} FROM hl",
    "facility_payloads": f"""WITH {_joined()}, {Z}, {HEALTH} SELECT 'facility:' || facility_id || ':health' AS key, '{{"risk_score":' || risk_score || ',"status":"' || facility_status || '","methane_zscore":' || {_text('methane_zscore', 2)} || ',"predictive_maintenance_score":' || predictive_maintenance_score || ',"anomaly":true,"batch_id":' || (well_ts // 5000) || '}}' AS payload FROM hl""",
    "health_lookup": f"WITH {_joined()}, {Z}, {HEALTH} SELECT 'facility:' || facility_id || ':health' AS key, risk_score, facility_status, well_ts + 300000 AS expires_at FROM hl WHERE well_ts + 300000 > (SELECT max(timestamp) FROM w)",
    "well_realtime_kpis": _windows("fast", "well_id", 5000, True),
    "ldar_hourly_compliance": _windows("slow", "well_id", 3600000, False),
    "facility_daily_emissions": DAILY,
    "retained_compliance": f"SELECT window_start, facility_id, reading_count FROM ({DAILY}) WHERE window_start >= (SELECT max(epoch_us(ts) // 1000) FROM events) - 604800000",
    "phi_history_last50": f"WITH {HISTORY} SELECT well_id, ts, n_history, first_ts, round(phi_sum, 3) AS phi_sum FROM fr",
    "phi_history_sessions": f"WITH {HISTORY} SELECT well_id, session, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, round(min(phi), 3) AS min_phi, round(max(phi), 3) AS max_phi FROM se GROUP BY 1, 2",
    "phi_history_length": f"WITH {HISTORY}, q AS (SELECT well_id, session, count(*) AS n, max(ts) AS last_ts FROM se GROUP BY 1, 2), y AS (SELECT *, row_number() OVER (PARTITION BY well_id ORDER BY session DESC) AS k FROM q) SELECT well_id, least(n, 50) AS history_length FROM y WHERE k = 1 AND (SELECT max(timestamp) FROM w) - last_ts < 3600000",
    "phi_history_entries": f"""WITH {HISTORY} SELECT 'pump:rul:bearing:' || well_id AS key, n, '{{"phi":' || {_text('phi', 4)} || ',"ts":' || ts || '}}' AS entry FROM r""",
    "phi_trend": f"WITH {HISTORY} SELECT well_id, ts, n_history, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(r2, 4) AS r2 FROM tr",
    "rul_prediction": f"WITH {LIFE} SELECT well_id, ts, n_history, rul_case, round(h, 3) AS hours_to_critical, rul_text FROM l",
    "rul_overlay": f"WITH {OVERLAY} SELECT well_id, timestamp, pump_alarm_level, rul, rul_method FROM o",
    "pump_alarm_latest": f"WITH {OVERLAY} SELECT well_id, ts, n, pump_alarm_level, failure_mode, round(pump_health_index, 4) AS pump_health_index, rul, rul_method, round(flow_deviation_pct, 4) AS flow_deviation_pct, round(pressure_deviation_pct, 4) AS pressure_deviation_pct, round(temp_rise_f, 4) AS temp_rise_f, key, expires_at FROM al",
    "pump_alarm_payloads": f"""WITH {OVERLAY} SELECT key, '{{"alarm":"' || pump_alarm_level || '","failure_mode":"' || failure_mode || '","phi":' || {_text('pump_health_index', 1)} || ',"rul":"' || rul || '","rul_method":"' || rul_method || '","flow_dev":' || {_text('flow_deviation_pct', 1)} || ',"pres_dev":' || {_text('pressure_deviation_pct', 1)} || ',"temp_rise":' || {_text('temp_rise_f', 1)} || ',"batch":' || (ts // 10000) || '}}' AS payload FROM al""",
    "alarm_lookup": f"WITH {OVERLAY} SELECT key, pump_alarm_level, expires_at FROM al WHERE key = 'pump:WELL-18:alarm' AND expires_at > (SELECT max(timestamp) FROM w)",
    "anomaly_events": f"WITH {EVENTS} SELECT well_id, well_ts, facility_id, round(methane_zscore, 4) AS methane_zscore, methane_ppm, emission_risk_level, round(pump_health_index, 4) AS pump_health_index, pump_alarm_level, pressure_psi, round(temp_rise_f, 4) AS temp_rise_f, round(flow_deviation_pct, 4) AS flow_deviation_pct FROM e",
    "anomaly_types": f"WITH {EVENTS} SELECT well_id, well_ts, anomaly_type FROM ty",
    "compliance_flags": f"WITH {_wells()} SELECT well_id, timestamp, CASE WHEN methane_ppm > 500 THEN 'REGULATORY_ACTION_REQUIRED' ELSE 'COMPLIANT' END AS compliance_flag, {_utc('timestamp')} AS stamped_at FROM w",
    "incident_records": f"WITH {FULL} SELECT * EXCLUDE (well_ts) FROM fu",
    "incident_log": f"WITH {FULL} SELECT id, content, {_text('severity', 2)} AS severity, generated_at AS stamped_at FROM tid",
    "similar_incidents": _similar(0.35),
    "similar_incidents_strict": _similar(0.70),
    "stream_interval_join": f"WITH {_joined()} SELECT {JOINED_LIST} FROM j",
    "stream_well_kpis": f"SELECT * FROM ({_windows('fast', 'well_id', 5000, True)}) WHERE window_end <= (WITH {_wells()} SELECT max(timestamp) - 10000 FROM w)",
    "stream_ldar_hourly": f"SELECT * FROM ({_windows('mixed', 'well_id', 3600000, False)}) WHERE window_end <= (WITH {_wells('mixed')} SELECT max(timestamp) - 10000 FROM w)",
    "stream_facility_daily": f"SELECT * FROM ({DAILY}) WHERE window_end <= (SELECT max(epoch_us(ts) // 1000) - 10000 FROM events)",
    "stream_pump_alarms": f"WITH {_pump()} SELECT well_id, timestamp, n, pump_alarm_level, failure_mode, round(pump_health_index, 4) AS pump_health_index FROM a WHERE pump_alarm_level IN ('L4_SHUTDOWN', 'L3_CRITICAL', 'L2_WARNING')",
    "stream_methane_zscore": f"WITH {_joined()}, {Z} SELECT well_id, tank_id, well_ts, tank_ts, round(methane_zscore, 6) AS methane_zscore, predictive_maintenance_score, is_anomaly FROM zz WHERE (well_ts // 5000) * 5000 + 5000 <= least((SELECT max(timestamp) FROM w), (SELECT max(timestamp) FROM t)) - 70000",
    "stream_facility_health_latest": f"WITH {_joined()}, {Z}, {HEALTH_CLOSED} SELECT {HEALTH_LIST} FROM hl",
    "stream_phi_history": f"WITH {HISTORY} SELECT well_id, ts, n_history, first_ts, round(phi_sum, 3) AS phi_sum, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(r2, 4) AS r2 FROM tr WHERE {CLOSED_PUMPS}",
    "stream_pump_alarm_latest": f"WITH {OVERLAY_CLOSED} SELECT {ALARM_LIST} FROM al",
    "stream_kpi_changes": _windows("fast", "well_id", 5000, True),
    "stream_served_keys": f"SELECT key, expires_at FROM (WITH {_joined()}, {Z}, {HEALTH_CLOSED} SELECT {HEALTH_LIST} FROM hl) UNION ALL SELECT key, expires_at FROM (WITH {OVERLAY_CLOSED} SELECT {ALARM_LIST} FROM al)",
    "kept_alarm_lookup": f"WITH {OVERLAY_CLOSED} SELECT key, ts, pump_alarm_level, rul, rul_method, expires_at FROM al WHERE well_id = 'WELL-18' AND expires_at > (SELECT max(timestamp) FROM w)",
    "stream_pump_health_as_of": f"WITH {_pump('fast', 'design_flow_bpd', 'design_pressure_psi', 'design_temperature_f', DATED_CURVES)} SELECT well_id, timestamp, design_flow_bpd, round(pump_health_index, 4) AS pump_health_index, failure_mode, pump_alarm_level FROM a",
    "stream_anomaly_events": f"WITH {EVENTS} SELECT {EVENT_LIST} FROM e WHERE {CLOSED_EVENTS}",
    "phi_trend_parsed": f"""WITH {HISTORY}, ls AS (SELECT *, row_number() OVER (PARTITION BY well_id ORDER BY ts DESC, n DESC) AS k FROM r), hx AS (SELECT *, (ts - min(ts) OVER (PARTITION BY well_id)) / 3600000.0e0 AS x FROM ls WHERE k <= 50)
  SELECT 'pump:rul:bearing:' || well_id AS key, count(*) AS n_history, round(CASE WHEN max(phi) = min(phi) OR max(x) = min(x) THEN 0.0e0 ELSE regr_slope(phi, x) END, 4) AS slope,
  round(CASE WHEN max(phi) = min(phi) OR max(x) = min(x) THEN avg(phi) ELSE regr_intercept(phi, x) END, 4) AS intercept, round(CASE WHEN max(phi) = min(phi) OR max(x) = min(x) THEN NULL ELSE regr_r2(phi, x) END, 4) AS r2 FROM hx GROUP BY well_id""",
    "incident_texts": f"WITH {FULL} SELECT well_id, well_ts, estimated_rul, content, id, generated_at FROM tid",
    "incident_retrieval": f"WITH {RETRIEVAL} SELECT well_id, well_ts, rank, rk.id, cosine FROM tid JOIN rk USING (question) WHERE rank <= 3",
    "retained_windows": f"SELECT window_start, facility_id, reading_count FROM ({DAILY}) WHERE window_end > (SELECT max(epoch_us(ts) // 1000) FROM events) - 604800000",
}
