"""The stream source reads a table that is one file, and one that is a folder of part files."""

from pathlib import Path

from fieldwatch.sources import telemetry
from fieldwatch.streaming import streams


def test_both_layouts(spark, sf_dir, tmp_path):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "events.parquet").write_bytes(Path(sf_dir, "events.parquet").read_bytes())
    table.repartition(3).write.parquet(str(tmp_path / "many" / "events.parquet"))
    for layout in ("one", "many"):
        source = telemetry.events(spark, str(tmp_path / layout), streaming=True)
        assert source.isStreaming and streams.run(source, layout).exceptAll(table).isEmpty() and streams.run(source, layout).count() == table.count()
