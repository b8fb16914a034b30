"""Late rows, and files that arrive one by one."""

from pyspark.sql import functions as F

from fieldwatch.operators import compliance
from fieldwatch.sources import telemetry
from fieldwatch.streaming import streams

T0 = 1704067200000


def test_late_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    row = lambda t, ppm: [("W", "F", t, ppm, 1.0, 1.0, 1.0, 1.0, None, "active", False)]
    for rows in (row(T0, 1.0), row(T0 + 60_000, 2.0), row(T0 + 120_000, 3.0), row(T0 + 1, 100.0), row(T0 + 180_000, 4.0)):
        spark.createDataFrame(rows, telemetry.WELL).coalesce(1).write.mode("append").parquet(folder)
    files = spark.readStream.schema(telemetry.WELL).option("maxFilesPerTrigger", 1).parquet(folder)
    got = streams.run(compliance.tumbling_stream(telemetry.with_event_time(files), ["well_id"], "5 seconds"), "late").orderBy("window_start").collect()
    assert [(r.window_start, r.max_methane) for r in got] == [(T0, 1.0), (T0 + 60_000, 2.0), (T0 + 120_000, 3.0)]


def test_file_source_declares_its_schema(spark, tmp_path):
    folder = str(tmp_path / "wells")
    telemetry.wells(telemetry.events(spark, "/root/testdata/sf0.001")).drop("n").write.parquet(folder)
    assert telemetry.read_telemetry(spark, folder, "well").count() == 1000
    stream = telemetry.read_telemetry(spark, folder, "well", streaming=True)
    assert stream.isStreaming and streams.run(stream.select("well_id", F.col("methane_ppm")), "copy").count() == 1000
