import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from logsight.session import use_utc

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield use_utc(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def log(spark):
    """The derived query log at sf0.01, written once."""
    from logsight.scratch import materialise
    from logsight.sources.query_log import query_log

    return materialise(query_log(spark, f"{TESTDATA}/sf0.01"), "log")


@pytest.fixture
def lake(spark):
    from logsight.sources.store import Lakehouse

    return Lakehouse(spark, tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "lake")
