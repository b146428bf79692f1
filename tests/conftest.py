import os
import sys
import tempfile
from pathlib import Path

import pytest

TOP = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, TOP)
os.environ["PYTHONPATH"] = TOP + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(DATA)
