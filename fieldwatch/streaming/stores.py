"""Stores that streams keep: rows by event date, key bucket and batch, and the newest row of each key.

A store is two folders of Parquet. ``log`` has what each batch brought, in partitions of event date, bucket and batch id, so writing a batch again replaces
just its own files. ``latest`` has snapshots, one a compaction, named by the last batch that they hold; a reader takes the newest finished
one and adds later batches from the log. A compaction that is repeated writes the same rows under the same name. Look-ups
name a key's bucket and the dates that can matter, and so read few partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.operators.serving import latest

BUCKETS = 16


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _files(spark, path)
    return files.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none where it doesn't exist."""
    files, at = _files(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(at)) if files.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def aged_by_name(spark: SparkSession, path: str) -> bool:
    """Gives a folder's data files ages a second apart in the order of their names, as a file stream takes them. False if the file system doesn't keep them."""
    files, at = _files(spark, path)
    found = lambda: sorted((x.getPath().getName(), x.getModificationTime()) for x in files.listStatus(at) if not x.getPath().getName().startswith(("_", ".")))
    before = found()
    first = max((t for _, t in before), default=0) - 1000 * len(before)
    for k, (name, _) in enumerate(before):
        files.setTimes(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, name), first + 1000 * k, -1)
    times = [t for _, t in found()]
    return all(a < b for a, b in zip(times, times[1:], strict=False))


def upsert(batch: DataFrame, batch_id: int, path: str, time_column: str, key: str) -> None:
    """Keeps a batch's rows. Doing it again changes nothing."""
    dated = batch.withColumns({"event_date": F.to_date(F.timestamp_millis(time_column)), "bucket": bucket_of(F.col(key)), "batch_id": F.lit(batch_id).cast("long")})
    dated.repartition("event_date", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "bucket", "batch_id").parquet(f"{path}/log")


def snapshot(spark: SparkSession, path: str) -> int:
    """The last batch in the newest finished snapshot, -1 if there is none."""
    found = [int(name.partition("=")[2]) for name in children(spark, f"{path}/latest") if exists(spark, f"{path}/latest/{name}/_SUCCESS")]
    return max(found, default=-1)


def log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All that was kept, with event_date, bucket and batch_id."""
    return spark.read.schema(f"{schema}, event_date date, bucket int, batch_id long").parquet(f"{path}/log")


def current(spark: SparkSession, path: str, schema: str, key: str, order: list[str], asked: Column | None = None) -> DataFrame:
    """The newest row of each key, from the newest snapshot and later batches; asked is a condition on partition columns and rows that holds for a row or for none that matters."""
    if not exists(spark, f"{path}/log"):
        return spark.createDataFrame([], schema)
    through = snapshot(spark, path)
    rows = log(spark, path, schema).filter(F.col("batch_id") > through).drop("batch_id")
    if through >= 0:
        held = spark.read.schema(f"{schema}, event_date date, bucket int").parquet(f"{path}/latest/through={through}")
        rows = rows.unionByName(held)
    rows = rows if asked is None else rows.filter(asked)
    return latest(rows.drop("event_date", "bucket"), key, order)


def compact(spark: SparkSession, path: str, schema: str, key: str, order: list[str], time_column: str, through: int) -> None:
    """Writes the snapshot that holds all batches up to ``through`` and drops those before the last one."""
    before = snapshot(spark, path)
    if before >= through or not exists(spark, f"{path}/log"):
        return
    rows = log(spark, path, schema).filter(F.col("batch_id").between(before + 1, through)).drop("event_date", "bucket", "batch_id")
    if before >= 0:
        rows = rows.unionByName(spark.read.schema(schema).parquet(f"{path}/latest/through={before}").drop("event_date", "bucket"))
    newest = latest(rows, key, order).withColumns({"event_date": F.to_date(F.timestamp_millis(time_column)), "bucket": bucket_of(F.col(key))})
    newest.repartition("bucket").write.mode("overwrite").partitionBy("event_date", "bucket").parquet(f"{path}/latest/through={through}")
    for name in children(spark, f"{path}/latest"):
        if int(name.partition("=")[2]) < before:
            remove(spark, f"{path}/latest/{name}")


def sink(path: str, schema: str, key: str, order: list[str], time_column: str, make: Callable[[DataFrame], DataFrame], every: int = 10) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps make(batch) and compacts after every so many batches."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        upsert(make(batch), batch_id, path, time_column, key)
        if batch_id % every == every - 1:
            compact(batch.sparkSession, path, schema, key, order, time_column, batch_id)

    return keep


def lookup(spark: SparkSession, path: str, schema: str, key: str, value: str, order: list[str], as_of_ms: int, ttl_ms: int) -> DataFrame:
    """A key's newest row if it hasn't expired. Only the key's bucket and the dates from as_of less the time to live are read."""
    day = F.to_date(F.timestamp_millis(F.lit(as_of_ms - ttl_ms)))
    asked = (F.col("event_date") >= day) & (F.col("bucket") == bucket_of(F.lit(value))) & (F.col(key) == value)
    return current(spark, path, schema, key, order, asked).filter(F.col("expires_at") > as_of_ms)


def drop_before(spark: SparkSession, folder: str, first_day: str, column: str = "event_date") -> list[str]:
    """Drops the whole dates of a dated folder that are before first_day (yyyy-mm-dd); no file is rewritten. The names of what went."""
    gone = [name for name in children(spark, folder) if name.startswith(f"{column}=") and name.partition("=")[2] < first_day]
    for name in gone:
        remove(spark, f"{folder}/{name}")
    return gone
