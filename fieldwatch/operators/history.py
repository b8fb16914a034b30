"""Health history of each pump: the last readings of a running session, its trend, and the remaining life.

A pump's history keeps its last ``cap`` readings and vanishes after ``idle`` without one. It is computed in chunks of a well and day: the last cap - 1
readings of each day are copied to the next days, as many as a session that never pauses for ``idle`` can need, so a well's whole life
is never sorted in one task and the frames are the same as over all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.functions.rules import decimal_text, first_match

DAY_MS, HOUR_MS = 86_400_000, 3_600_000.0
CAP, IDLE_MS, LEAST = 50, 3_600_000, 5
CRITICAL_PHI = 25.0


def carried_days(cap: int = CAP, idle_ms: int = IDLE_MS) -> int:
    """How many later days a day's last readings can matter to: a session has a reading less than ``idle`` apart, so so many a day at least."""
    least_a_day = DAY_MS // idle_ms - 1
    return -(-(cap - 1) // least_a_day)


def chunked(readings: DataFrame, cap: int = CAP, idle_ms: int = IDLE_MS) -> DataFrame:
    """readings (well_id, ts, n, phi) with their chunk's day, copies from earlier days (copied), and gap: 1 where a session starts."""
    rows = readings.withColumn("day", F.floor(F.col("ts") / DAY_MS))
    last = Window.partitionBy("well_id", "day").orderBy(F.desc("ts"), F.desc("n"))
    tail = rows.withColumn("__k", F.row_number().over(last)).filter(F.col("__k") < cap).drop("__k")
    copies = tail.withColumn("__later", F.explode(F.sequence(F.lit(1), F.lit(carried_days(cap, idle_ms))))).withColumn("day", F.col("day") + F.col("__later")).drop("__later")
    both = rows.withColumn("copied", F.lit(0)).unionByName(copies.withColumn("copied", F.lit(1)))
    before = F.lag("ts").over(Window.partitionBy("well_id", "day").orderBy("ts", "n"))
    return both.withColumn("gap", F.when(F.col("ts") - before < idle_ms, 0).otherwise(1))


def with_history(readings: DataFrame, cap: int = CAP, idle_ms: int = IDLE_MS) -> DataFrame:
    """Each reading with what its history holds: n_history, first_ts, phi_sum, phi_spread and the least-squares line over hours since the first reading.

    slope and intercept are null for fewer than two times; r2 is null for a constant index.
    """
    sessions = chunked(readings, cap, idle_ms).withColumn("session", F.sum("gap").over(Window.partitionBy("well_id", "day").orderBy("ts", "n")))
    frame = Window.partitionBy("well_id", "day", "session").orderBy("ts", "n").rowsBetween(-(cap - 1), 0)
    hours = (F.col("ts") - F.col("day") * DAY_MS) / HOUR_MS
    rows = sessions.withColumn("__h", hours).select(
        "well_id", "ts", "n", "phi", "copied", "__h", *[c for c in readings.columns if c not in ("well_id", "ts", "n", "phi")],
        F.count("*").over(frame).alias("n_history"), F.first("ts").over(frame).alias("first_ts"), F.first("__h").over(frame).alias("__h0"), F.sum("phi").over(frame).alias("phi_sum"),
        (F.max("phi").over(frame) - F.min("phi").over(frame)).alias("phi_spread"), (F.max("__h").over(frame) - F.min("__h").over(frame)).alias("__span"),
        F.regr_slope("phi", "__h").over(frame).alias("__slope"), F.regr_intercept("phi", "__h").over(frame).alias("__intercept"), F.regr_r2("phi", "__h").over(frame).alias("__r2"),
    )
    flat, moment = F.col("phi_spread") == 0, F.col("__span") == 0
    fitted = rows.filter("copied = 0").withColumns(
        {
            "slope": F.when(flat | moment, 0.0).otherwise(F.round("__slope", 9)),
            "intercept": F.when(flat | moment, F.col("phi_sum") / F.col("n_history")).otherwise(F.col("__intercept") + F.col("__slope") * F.col("__h0")),
            "r2": F.when(~flat & ~moment, F.col("__r2")),
        }
    )
    return fitted.drop("copied", "__h", "__h0", "__span", "__slope", "__intercept", "__r2")


def session_summaries(readings: DataFrame, cap: int = CAP, idle_ms: int = IDLE_MS) -> DataFrame:
    """Per well and session: its readings, first and last time, least and largest index. Session numbers add up over day summaries."""
    rows = chunked(readings, cap, idle_ms).filter("copied = 0").withColumn("local", F.sum("gap").over(Window.partitionBy("well_id", "day").orderBy("ts", "n")))
    parts = rows.groupBy("well_id", "day", "local").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min("phi").alias("min_phi"), F.max("phi").alias("max_phi"))
    # one row a well and day
    starts = rows.groupBy("well_id", "day").agg(F.sum("gap").alias("starts"))
    earlier = F.coalesce(F.sum("starts").over(Window.partitionBy("well_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = parts.join(starts.withColumn("earlier", earlier).drop("starts"), ["well_id", "day"]).withColumn("session", F.col("local") + F.col("earlier"))
    return numbered.groupBy("well_id", "session").agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.min("min_phi").alias("min_phi"), F.max("max_phi").alias("max_phi"))


def history_length(readings: DataFrame, as_of_ms: int, cap: int = CAP, idle_ms: int = IDLE_MS) -> DataFrame:
    """The length of each well's history at a time; wells idle for longer have none."""
    past = readings.filter(F.col("ts") <= as_of_ms)
    latest = session_summaries(past, cap, idle_ms).groupBy("well_id").agg(F.max(F.struct("session", "n", "last_ts")).alias("s"))
    return latest.filter(as_of_ms - F.col("s.last_ts") < idle_ms).select("well_id", F.least(F.col("s.n"), F.lit(cap)).alias("history_length"))


def parsed_entries(entries: DataFrame, entry: str = "entry") -> tuple[DataFrame, DataFrame]:
    """Rows with phi and ts from their JSON entry, and those set aside: null, not JSON, or without a number as phi and a whole number as ts."""
    rows = entries.withColumn("__e", F.from_json(entry, "phi double, ts bigint", {"mode": "PERMISSIVE"}))
    whole = F.coalesce(F.col("__e.phi").isNotNull() & F.col("__e.ts").isNotNull(), F.lit(False))
    return rows.filter(whole).select(*entries.columns, "__e.phi", "__e.ts"), rows.filter(~whole).drop("__e")


def latest_history(readings: DataFrame, cap: int = CAP, idle_ms: int = IDLE_MS) -> DataFrame:
    """The newest reading of each well with its history; found by a grouped maximum, not a sort."""
    rows = with_history(readings, cap, idle_ms)
    names = [c for c in rows.columns if c not in ("well_id", "ts", "n")]
    newest = rows.groupBy("well_id").agg(F.max(F.struct("ts", "n", *names)).alias("r"))
    return newest.select("well_id", "r.*")


def remaining_life(history: DataFrame, batch_ms: int = 10_000) -> DataFrame:
    """Adds hours_to_critical, rul_case and rul_text. Now is the end of the reading's batch, an event-time bucket as long as the pump query's trigger."""
    end = (F.floor(F.col("ts") / batch_ms) + 1) * batch_ms
    to_critical = (CRITICAL_PHI - F.col("intercept")) / F.col("slope") - (end - F.col("first_ts")) / HOUR_MS
    rows = history.withColumn("hours_to_critical", F.when((F.col("n_history") >= LEAST) & (F.col("slope") < 0), to_critical))
    case = first_match(
        [("COLLECTING", f"n_history < {LEAST}"), ("STABLE", "slope >= 0"), ("OVERDUE", "hours_to_critical <= 0"), ("MINUTES", "hours_to_critical < 1"), ("HOURS", "hours_to_critical < 48")], "DAYS"
    )
    return rows.withColumn("rul_case", case).withColumn("rul_text", rul_text())


def rul_text() -> Column:
    """The remaining life in words; numbers are rounded first, so texts are the same everywhere."""
    slope, r2, h = decimal_text(F.col("slope"), 3), F.coalesce(decimal_text(F.col("r2"), 2), F.lit("NaN")), F.col("hours_to_critical")
    tail = F.concat(F.lit(" to critical (LinearRegression: slope="), slope, F.lit(" PHI/hr, R²="), r2, F.lit(", n="), F.col("n_history").cast("string"), F.lit(")"))
    case = F.col("rul_case")
    return (
        F.when(case == "COLLECTING", F.concat(F.lit("collecting history ("), F.col("n_history").cast("string"), F.lit(f"/{LEAST} readings)")))
        .when(case == "STABLE", F.concat(F.lit("stable or improving (slope=+"), slope, F.lit(" PHI/hr, R²="), r2, F.lit(")")))
        .when(case == "OVERDUE", F.concat(F.lit("OVERDUE — model projected PHI critical "), decimal_text(-h, 1), F.lit(" hrs ago (R²="), r2, F.lit(", slope="), slope, F.lit(" PHI/hr)")))
        .when(case == "MINUTES", F.concat(F.lit("~"), decimal_text(h * 60, 0), F.lit(" min"), tail))
        .when(case == "HOURS", F.concat(F.lit("~"), decimal_text(h, 1), F.lit(" hrs"), tail))
        .otherwise(F.concat(F.lit("~"), decimal_text(h / 24, 1), F.lit(" days"), tail))
    )


def fitted_entries(entries: DataFrame, cap: int = CAP) -> DataFrame:
    """The line through the last ``cap`` readings that each key's entries (key, n, phi, ts) hold, however they are ordered: key, n_history, slope, intercept, r2.

    The limit on the rank lets each task drop older entries before the shuffle, so a key's whole life isn't gathered.
    """
    newest = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("ts"), F.desc("n")))
    held = entries.withColumn("__k", newest).filter(F.col("__k") <= cap)
    starts = held.groupBy("key").agg(F.min("ts").alias("first_ts"))
    rows = held.join(starts, "key").withColumn("x", (F.col("ts") - F.col("first_ts")) / HOUR_MS)
    still = (F.max("phi") == F.min("phi")) | (F.max("x") == F.min("x"))
    fit = {"slope": (F.regr_slope("phi", "x"), F.lit(0.0)), "intercept": (F.regr_intercept("phi", "x"), F.avg("phi")), "r2": (F.regr_r2("phi", "x"), F.lit(None).cast("double"))}
    return rows.groupBy("key").agg(F.count("*").alias("n_history"), *[F.when(still, flat).otherwise(line).alias(name) for name, (line, flat) in fit.items()])


def overlaid_latest(alarms: DataFrame, readings: DataFrame, batch_ms: int = 10_000) -> DataFrame:
    """rul_overlay for one alarm a well (well_id, ts, rul, rul_method): what the regression says of the newest bearing fault in the alarm's batch takes the rule's place.

    readings (well_id, ts, n, phi, failure_mode) count only of the alarm's day and the days that can be in its history, so no more of a well's life is sorted; the text is made for the alarms alone.
    """
    day = lambda c: F.floor(F.col(c) / DAY_MS)
    at = alarms.select("well_id", F.col("ts").alias("__at"))
    near = readings.join(at, "well_id").filter(day("ts").between(day("__at") - carried_days(), day("__at")))
    fits = with_history(near).filter((F.col("failure_mode") == "BEARING_FAILURE_RISK") & (F.floor(F.col("ts") / batch_ms) == F.floor(F.col("__at") / batch_ms)))
    columns = ["n_history", "first_ts", "slope", "intercept", "r2"]
    newest = fits.groupBy("well_id").agg(F.max(F.struct("ts", "n", *columns)).alias("f")).select("well_id", "f.ts", *[f"f.{c}" for c in columns])
    texts = remaining_life(newest, batch_ms).select("well_id", F.col("rul_text").alias("__text"))
    rows = alarms.join(texts, "well_id", "left")
    return rows.withColumns({"rul": F.coalesce("__text", "rul"), "rul_method": F.when(F.col("__text").isNotNull(), "linear_regression").otherwise(F.col("rul_method"))}).drop("__text")


def rul_overlay(report: DataFrame, predictions: DataFrame, batch_ms: int = 10_000) -> DataFrame:
    """A pump report with rul and rul_method. A bearing fault's prediction (well_id, ts, rul_text) goes to all rows of its well and batch; the newest counts."""
    batch = F.floor(F.col("ts") / batch_ms)
    per_batch = predictions.groupBy("well_id", batch.alias("batch")).agg(F.max(F.struct("ts", "n", "rul_text")).alias("p")).select("well_id", "batch", F.col("p.rul_text").alias("__text"))
    rows = report.withColumn("batch", F.floor(F.col("timestamp") / batch_ms)).join(per_batch, ["well_id", "batch"], "left")
    return rows.withColumns({"rul": F.coalesce("__text", "rul_estimate"), "rul_method": F.when(F.col("__text").isNotNull(), "linear_regression").otherwise("rule_based")}).drop("__text", "batch")
