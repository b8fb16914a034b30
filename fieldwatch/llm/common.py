"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as the contracts define it: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once an application, so that executors need no copy of it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='fieldwatch-code-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, str(source.relative_to(package.parent)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``). Where the session names none, one in the warehouse is set, or on a local master, as in tests, a fresh local one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = spark.sparkContext.getCheckpointDir()
        alone = spark.sparkContext.master.split("[")[0] == "local"
        found = current or (tempfile.mkdtemp(prefix="fieldwatch-") if alone else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared-{uuid.uuid4().hex}")
        if not current:
            spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, kind: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df computed once and kept in the shared folder, so that a lost executor costs no lineage; Spark's cleaner removes it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once a row, however often body refers to it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text, array<string>; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \x09-\x0D]+"), "")
