"""The package on Python workers that have no copy of it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


def send(spark: SparkSession) -> None:
    """Sends the package to the workers, once an application."""
    sc = spark.sparkContext
    if sc.applicationId not in _sent:
        package = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp(prefix='fieldwatch-code-')}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, str(source.relative_to(package.parent)))
        sc.addPyFile(archive)
        _sent.add(sc.applicationId)
