import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "shared")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF
