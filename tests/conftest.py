import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(4)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield spark
    spark.stop()


@pytest.fixture
def small_batches(spark):
    """Several Arrow batches per task, as large tables have."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "20")
    yield
    spark.conf.set(conf, before)


@pytest.fixture
def one(spark):
    """Value of an expression over a single text column ``x``."""
    from pyspark.sql import functions as F

    def run(expression, *values):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, x string")
        out = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in out] if len(values) > 1 else out[0]["y"]

    return run
