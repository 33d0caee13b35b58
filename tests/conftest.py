import os
import sys
import tempfile
import time

# Timestamps collected to Python are shown in the process's zone: pin UTC.
os.environ["TZ"] = "UTC"
time.tzset()

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridsense.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", "gridsense-tests", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.maxMetadataStringLength": "10000",  # whole scan details in plans
    })
    s.sparkContext.setLogLevel("ERROR")
    # The shared folder is the one the session names; tests set their own
    # only where none is configured.
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridsense-test-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from gridsense.session import new_work_path
    return new_work_path(spark, "t")


def messages(spark, payloads, topic="IoT/energy/Airconditioning/HVAC1"):
    rows = [(topic, p) for p in payloads]
    return spark.createDataFrame(rows, "topic STRING, payload STRING")


def readings(spark, rows, sensor=None):
    """rows of (timestamp text, value) -> (Sensor?, DateTime, NumVal)."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "t STRING, v DOUBLE").select(
        F.to_timestamp("t").alias("DateTime"), F.col("v").alias("NumVal"))
    if sensor is not None:
        df = df.select(F.lit(sensor).alias("Sensor"), "*")
    return df


def ts(text):
    import datetime as dt
    return dt.datetime.fromisoformat(text)
