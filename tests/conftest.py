import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Evaluate a Column function over plain values."""

    def run(fn, values, dtype="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
        return [r["out"] for r in rows.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
