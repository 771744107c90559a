import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from keyflow.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("keyflow-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(params=[None, 2], ids=["whole", "cut"])
def layout(request, spark):
    """Runs a test with keys left whole, and with every key of more than two rows cut up."""
    if request.param:
        spark.conf.set("keyflow.rowsPerTask", str(request.param))
    yield request.param
    spark.conf.unset("keyflow.rowsPerTask")


@pytest.fixture
def readings(spark):
    """Rows ``(id, seconds, level)`` as a table with event time and sequence number."""

    def make(*rows):
        numbered = [(seq, *row) for seq, row in enumerate(rows)]
        table = spark.createDataFrame(numbered, "seq bigint, id string, seconds bigint, vc int")
        return table.selectExpr("seq", "id", "CAST(timestamp_seconds(seconds) AS TIMESTAMP_NTZ) AS ts", "vc")

    return make


def seconds(time):
    """Seconds since the epoch of a zone-less time."""
    from datetime import datetime

    return int((time - datetime(1970, 1, 1)).total_seconds())
