"""Streams of telemetry run to their end into tables and stores, and read back.

``run`` gives each run its own table and checkpoint; ``resume`` goes on from a named pair. Every analytic step stands before the sink, where the optimiser reaches it;
sinks only keep what a batch brings, so that a batch that is repeated after a failure changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fieldwatch.operators import anomaly, classify, compliance, history, joins, pump, serving
from fieldwatch.sources import telemetry
from fieldwatch.streaming import state, stores

DELAY_MS = 10_000
#: Events in a file of a replay, and files in a micro-batch of it: what joins and windows hold grows with a batch, not with the table.
FILE_ROWS, BATCH_FILES = 500_000, 4
#: State partitions a core; each has a few files in every step of every batch.
STATE_PARTITIONS = 3


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, or else the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


@contextmanager
def lean_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start herein spread their state over at most so many partitions a core, and hold one version of it. Those that go on from a checkpoint keep their partitions."""
    partitions = "spark.sql.shuffle.partitions"
    settings = {partitions: min(int(spark.conf.get(partitions)), STATE_PARTITIONS * spark.sparkContext.defaultParallelism), "spark.sql.streaming.maxBatchesToRetainInMemory": 1}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def start(stream: DataFrame, table: str, checkpoint: str, mode: str = "append"):
    """A running query that persists a derived stream in a table; it stops when all that was there at the start is done."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with lean_state(stream.sparkSession):
        return writer.toTable(table)


def start_sink(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """A running query whose batches go to a foreachBatch function; it stops when all that was there at the start is done."""
    with lean_state(stream.sparkSession):
        return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start()


def resume(stream: DataFrame, table: str, checkpoint: str) -> DataFrame:
    """Goes on from a named table and checkpoint, or begins them: what earlier runs have done isn't done again, and open windows and joins are taken up where they were."""
    start(stream, table, checkpoint).awaitTermination()
    return stream.sparkSession.table(table)


def supervise(queries: list[StreamingQuery], until_all: bool = True, poll_s: float = 1.0) -> None:
    """Waits for queries of one session: for all of them to end, or for any. When one fails, the others are stopped and its failure is raised; none is left running on return."""
    try:
        while True:
            over = [q for q in queries if not q.isActive]
            for q in over:
                q.awaitTermination()  # raises the query's failure
            if len(over) == len(queries) or (over and not until_all):
                return
            next(q for q in queries if q.isActive).awaitTermination(poll_s)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def run(stream: DataFrame, name: str) -> DataFrame:
    """The rows that the stream yields, from a new table."""
    spark, table = stream.sparkSession, f"{name}_{uuid.uuid4().hex}"
    query = start(stream, table, f"{checkpoint_root(spark)}/checkpoint-{table}")
    query.awaitTermination()
    return spark.table(table)


def wells(spark: SparkSession, sf_dir: str, profile: str = "fast") -> DataFrame:
    return telemetry.with_event_time(telemetry.wells(telemetry.events(spark, sf_dir, streaming=True), profile))


def tanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.with_event_time(telemetry.tanks(telemetry.events(spark, sf_dir, streaming=True)))


def replay(spark: SparkSession, sf_dir: str, kind: str, profile: str = "fast") -> DataFrame:
    """The events, with the columns that readings are made of, as a stream of bounded micro-batches, as a feed would bring them: in the order of the times of the readings of a kind.

    A table's files may hold any times in any order, and a batch with rows from before the last one's watermark would lose them. So a table of more than a batch's events is
    written once more, each file a range of times and of just the age that puts it in its turn; within a batch the order doesn't matter. Where a file system doesn't keep
    ages, all files are one batch.
    """
    used = ["event_id", "ts", "user_id"]
    table = telemetry.events(spark, sf_dir).select(*used)
    files = -(-table.count() // FILE_ROWS)
    if files <= BATCH_FILES:
        return telemetry.events(spark, sf_dir, streaming=True).select(*used)
    place = new_place(spark, "replay")
    telemetry.with_time(table, kind, profile).repartitionByRange(files, "__at").drop("__at").write.option("maxRecordsPerFile", 0).parquet(place)
    reader = spark.readStream.schema(table.schema)
    return (reader.option("maxFilesPerTrigger", BATCH_FILES) if stores.aged_by_name(spark, place) else reader).parquet(place)


def _feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Well and tank readings, replayed."""
    return telemetry.with_event_time(telemetry.wells(replay(spark, sf_dir, "well"))), telemetry.with_event_time(telemetry.tanks(replay(spark, sf_dir, "tank")))


def _clean(well: DataFrame, tank: DataFrame) -> tuple[DataFrame, DataFrame]:
    return classify.clean_wells(classify.well_metrics(well)), classify.clean_tanks(classify.tank_metrics(tank))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.interval_join_stream(*_clean(*_feeds(spark, sf_dir)))


def judged(spark: SparkSession, sf_dir: str, window: str = "5 seconds") -> DataFrame:
    """Joined readings with their z-scores."""
    well, tank = _clean(*_feeds(spark, sf_dir))
    timed = well.withWatermark("event_timestamp", f"{DELAY_MS} milliseconds")
    return anomaly.zscores_stream(joins.interval_join_stream(well, tank), window=window, wells=timed, join=lambda rows: joins.interval_join_stream(rows, tank, window=window))


def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(joined(spark, sf_dir).drop("well_event_timestamp", "tank_event_timestamp"), "joined")


def methane_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(spark, sf_dir).select("well_id", "tank_id", "well_ts", "tank_ts", "methane_zscore", "predictive_maintenance_score", "is_anomaly")
    return run(rows, "zscores")


def well_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(compliance.tumbling_stream(wells(spark, sf_dir), ["well_id"], "5 seconds"), "kpis")


def ldar_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(compliance.tumbling_stream(wells(spark, sf_dir, "mixed"), ["well_id"], "1 hour").drop("min_methane"), "ldar")


def facility_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(compliance.facility_daily_stream(wells(spark, sf_dir, "slow")), "daily")


def pump_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pump.pump_health(wells(spark, sf_dir)).filter(F.col("pump_alarm_level").isin("L4_SHUTDOWN", "L3_CRITICAL", "L2_WARNING"))
    return run(rows.select("well_id", "timestamp", "n", "pump_alarm_level", "failure_mode", "pump_health_index"), "alarms")


def new_place(spark: SparkSession, name: str) -> str:
    """A folder for a store and its checkpoint that nothing uses yet."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


HEALTH = "facility_id string, well_ts long, tank_ts long, well_id string, tank_id string, risk_score int, facility_status string, methane_zscore double, predictive_maintenance_score int, key string, expires_at long"
HEALTH_KEY, HEALTH_ORDER = "facility_id", ["well_ts", "tank_ts", "well_id", "tank_id"]
ALARM = (
    "well_id string, ts long, n long, pump_alarm_level string, failure_mode string, pump_health_index double, rul string, rul_method string, flow_deviation_pct double, "
    "pressure_deviation_pct double, temp_rise_f double, key string, expires_at long"
)
ALARM_KEY, ALARM_ORDER = "well_id", ["ts", "n"]
LIFE = "well_batch string, well_id string, ts long, n long, rul_text string"
KPI = "window_key string, window_start long, window_end long, well_id string, avg_methane double, max_methane double, min_methane double, reading_count long, version long"


def serve_facilities(judged: DataFrame, place: str, every: int = 10) -> StreamingQuery:
    """Keeps the newest anomalous reading of each facility from a stream of judged joined readings."""
    sink = stores.sink(place, HEALTH, HEALTH_KEY, HEALTH_ORDER, "well_ts", serving.facility_health, every)
    names = [c.split()[0] for c in HEALTH.split(", ")][:-2]
    return start_sink(judged.select(*names, "is_anomaly"), sink, f"{place}/checkpoint")  # event times end here: a join takes one a side


def facilities(spark: SparkSession, place: str) -> DataFrame:
    return stores.current(spark, place, HEALTH, HEALTH_KEY, HEALTH_ORDER)


EXTRA = "facility_id string, pump_alarm_level string, failure_mode string, pump_health_index double, rul_estimate string, flow_deviation_pct double, pressure_deviation_pct double, temp_rise_f double"


def pump_history(wells: DataFrame, cap: int = history.CAP, idle_ms: int = history.IDLE_MS) -> DataFrame:
    """The pump report of a stream of well readings with event_timestamp, final readings only, with each reading's history and trend."""
    report = pump.pump_health(classify.well_metrics(wells)).withWatermark("event_timestamp", f"{DELAY_MS} milliseconds")
    names = [c.split()[0] for c in EXTRA.split(", ")]
    readings = report.select("well_id", "event_timestamp", F.col("timestamp").alias("ts"), "n", F.col("pump_health_index").alias("phi"), F.to_json(F.struct(*names)).alias("extra"))
    rows = state.history_stream(readings, cap, idle_ms).withColumn("extra", F.from_json("extra", EXTRA))
    return rows.select("well_id", "ts", "n", "phi", "n_history", "first_ts", "phi_sum", "slope", "intercept", "r2", "extra.*")


def serve_pumps(reports: DataFrame, place: str, every: int = 10, batch_ms: int = 10_000) -> StreamingQuery:
    """Keeps the newest alarm of each pump, and the newest remaining life of each pump and event-time batch, from a stream of pump_history.

    Both come from one pass over a batch's rows; alarms get their life when they are read, because it may come with a later batch.
    """
    keep_alarms = stores.sink(f"{place}/alarms", ALARM, ALARM_KEY, ALARM_ORDER, "ts", lambda rows: serving.pump_alarms(rows.withColumns({"timestamp": F.col("ts"), "rul": F.col("rul_estimate"), "rul_method": F.lit("rule_based")}).drop("ts")), every)
    well_batch = F.concat_ws("/", "well_id", F.floor(F.col("ts") / batch_ms).cast("string"))

    def lives(rows: DataFrame) -> DataFrame:
        told = history.remaining_life(rows.filter("failure_mode = 'BEARING_FAILURE_RISK'"), batch_ms)
        return serving.latest(told.select(well_batch.alias("well_batch"), "well_id", "ts", "n", "rul_text"), "well_batch", ["ts", "n"])

    keep_lives = stores.sink(f"{place}/lives", LIFE, "well_batch", ["ts", "n"], "ts", lives, every)

    def keep(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        keep_alarms(rows, batch_id)
        keep_lives(rows, batch_id)
        rows.unpersist()

    return start_sink(reports, keep, f"{place}/checkpoint")


def _with_life(spark: SparkSession, alarms: DataFrame, place: str, asked=None, batch_ms: int = 10_000) -> DataFrame:
    lives = stores.current(spark, f"{place}/lives", LIFE, "well_batch", ["ts", "n"], asked).select("well_batch", "rul_text")
    rows = alarms.withColumn("well_batch", F.concat_ws("/", "well_id", F.floor(F.col("ts") / batch_ms).cast("string"))).join(lives, "well_batch", "left")
    return rows.withColumns({"rul": F.coalesce("rul_text", "rul"), "rul_method": F.when(F.col("rul_text").isNotNull(), "linear_regression").otherwise(F.col("rul_method"))}).drop("well_batch", "rul_text")


def served_pumps(spark: SparkSession, place: str) -> DataFrame:
    return _with_life(spark, stores.current(spark, f"{place}/alarms", ALARM, ALARM_KEY, ALARM_ORDER), place)


def alarm_of(spark: SparkSession, place: str, well_id: str, as_of_ms: int) -> DataFrame:
    """A pump's alarm if it hasn't expired, from the kept files of its bucket and dates."""
    alarms = stores.lookup(spark, f"{place}/alarms", ALARM, ALARM_KEY, well_id, ALARM_ORDER, as_of_ms, serving.ALARM_TTL_MS)
    recent = F.col("event_date") >= F.to_date(F.timestamp_millis(F.lit(as_of_ms - serving.ALARM_TTL_MS)))
    return _with_life(spark, alarms, place, recent & (F.col("well_id") == well_id))


def facility_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "facilities")
    supervise([serve_facilities(judged(spark, sf_dir), place)])
    return facilities(spark, place)


def phi_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(pump_history(wells(spark, sf_dir, "mixed")), "phi_history")


def pump_alarm_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "pumps")
    supervise([serve_pumps(pump_history(wells(spark, sf_dir, "mixed")), place)])
    return served_pumps(spark, place)


def both_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and expiry of both stores, kept by two queries that run side by side in one session."""
    one, two = new_place(spark, "facilities"), new_place(spark, "pumps")
    supervise([serve_facilities(judged(spark, sf_dir), one), serve_pumps(pump_history(wells(spark, sf_dir, "mixed")), two)])
    return facilities(spark, one).select("key", "expires_at").unionByName(served_pumps(spark, two).select("key", "expires_at"))


def kept_alarm(spark: SparkSession, sf_dir: str, well_id: str, as_of_ms: int) -> DataFrame:
    place = new_place(spark, "pumps")
    supervise([serve_pumps(pump_history(wells(spark, sf_dir, "mixed")), place)])
    return alarm_of(spark, place, well_id, as_of_ms)


def keep_changes(windows: DataFrame, place: str) -> StreamingQuery:
    """Keeps every change of a stream's windows per well as a row with the version that made it: the batch id, so that a repeated batch repeats its versions."""
    rows = windows.withColumn("window_key", F.concat_ws("/", "well_id", F.col("window_start").cast("string")))

    def keep(batch: DataFrame, batch_id: int) -> None:
        stores.upsert(batch.withColumn("version", F.lit(batch_id).cast("long")), batch_id, place, "window_start", "window_key")

    return start_sink(rows, keep, f"{place}/checkpoint", "update")


def changes(spark: SparkSession, place: str) -> DataFrame:
    return stores.log(spark, place, KPI).drop("event_date", "bucket", "batch_id")


def merged(spark: SparkSession, place: str) -> DataFrame:
    """The newest version of each window."""
    return stores.current(spark, place, KPI, "window_key", ["version"]).drop("window_key", "version")


def kpi_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_place(spark, "changes")
    supervise([keep_changes(compliance.tumbling_stream(wells(spark, sf_dir), ["well_id"], "5 seconds"), place)])
    return merged(spark, place)


def health_as_of(spark: SparkSession, sf_dir: str, curves: DataFrame) -> DataFrame:
    rows = pump.judged(pump.with_curve_as_of(classify.active_pumps(classify.well_metrics(wells(spark, sf_dir))), curves))
    return run(rows.select("well_id", "timestamp", "design_flow_bpd", "pump_health_index", "failure_mode", "pump_alarm_level"), "as_of")


def anomaly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anomaly.anomaly_events on streams: anomalous readings, once each, meet the pump reports of their window."""
    size, delay = f"{anomaly.BUCKET_MS} milliseconds", f"{DELAY_MS} milliseconds"
    well, tank = _feeds(spark, sf_dir)
    once = anomaly.anomalous_stream(joins.interval_join_stream(*_clean(well, tank)), window=size)
    reports = pump.pump_health(classify.well_metrics(well)).withWatermark("event_timestamp", delay)
    reports = reports.select(F.window("event_timestamp", size).alias("w"), "well_id", F.col("timestamp").alias("well_ts"), "facility_id", "methane_ppm", "emission_risk_level", "pump_health_index", "pump_alarm_level", "pressure_psi", "temp_rise_f", "flow_deviation_pct")
    return run(once.join(reports, ["w", "well_id", "well_ts"]).drop("w"), "anomalies")


INCIDENT = "well_id string, well_ts long, question string, content string, id string"


def logged_incidents(rows: DataFrame, repeats: int = 1) -> DataFrame:
    """Incidents appended to a log, as often as said under one batch, and read back: each once."""
    spark, place = rows.sparkSession, new_place(rows.sparkSession, "incidents")
    for _ in range(repeats):
        stores.upsert(rows.select("well_id", "well_ts", "question", "content", "id"), 0, place, "well_ts", "id")
    return stores.current(spark, place, INCIDENT, "id", ["well_ts"])


WINDOW = "window_start long, window_end long, facility_id string, avg_methane double, max_methane double, reading_count long, well_count long"


def retained_windows(windows: DataFrame, as_of_ms: int, days: int) -> DataFrame:
    """Daily windows kept by date; dates that ended so many days before as_of are dropped whole, and the rest is read by its partitions."""
    spark, place = windows.sparkSession, new_place(windows.sparkSession, "windows")
    names = [c.split()[0] for c in WINDOW.split(", ")]
    stores.upsert(windows.select(*names), 0, place, "window_start", "facility_id")
    first = datetime.fromtimestamp(as_of_ms / 1000 - days * 86_400, UTC).date()
    stores.drop_before(spark, f"{place}/log", first.isoformat())
    return stores.log(spark, place, WINDOW).filter(F.col("event_date") >= F.lit(first))
