import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from msgledger.session import get_spark, ship_package  # noqa: E402

ship_package()


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="msgledger-tests-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column function to a list of texts and return the results as plain values."""
    from pyspark.sql import functions as F

    def run(fn, values, dtype="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
        return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]

    return run


SF = "/root/testdata/sf0.001"
