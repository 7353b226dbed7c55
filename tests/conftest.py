import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tallyframe-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def restored_conf(spark):
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def medium():
    return MEDIUM


@pytest.fixture
def plan():
    """Final physical plan of a DataFrame as text, after running it."""

    def text(df):
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        return text.split("\n+- == Initial Plan ==")[0]

    return text


@pytest.fixture
def events(spark):
    """Build placements from ``(time text, user, colour, coordinate)`` rows."""

    def build(*rows, kind="timestamp_ntz"):
        df = spark.createDataFrame(
            [(r + (None,) * 4)[:4] for r in rows],
            "ts string, user_id string, pixel_color string, coordinate string")
        return df.withColumn("ts", df.ts.cast(kind))

    return build
