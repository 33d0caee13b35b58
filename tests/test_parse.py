from pyspark.sql import functions as F

from gridsense.functions.parse import (decode_json, encode_json, format_payload, parse_reading,
                                       raw_envelope, sensor_from_topic)
from gridsense.plans.jobs import ingest_raw, sensor_readings
from tests.conftest import messages, ts


def test_gauge_reading(spark):
    df = parse_reading(messages(spark, ["2023-01-01 00:15:00 | 42.5"]))
    row = df.collect()[0]
    assert row.DateTime == ts("2023-01-01 00:15:00")
    assert row.NumVal == 42.5
    assert df.columns == ["topic", "DateTime", "NumVal"]


def test_malformed_gives_nulls_and_is_dropped(spark):
    m = messages(spark, ["bad", "2023-01-01 00:15:00 | x", "2023-01-01 00:30:00 | 1.5"])
    rows = parse_reading(m).collect()
    assert (rows[0].DateTime, rows[0].NumVal) == (None, None)
    assert rows[1].NumVal is None
    kept = sensor_readings(m).collect()
    assert [(r.Sensor, r.NumVal) for r in kept] == [("HVAC1", 1.5)]


def test_value_text_kept_for_flagged_streams(spark):
    df = parse_reading(messages(spark, ["2022-12-22 05:03:00 | 0.44f"]), numeric=False)
    assert df.collect()[0].Val == "0.44f"


def test_sensor_from_topic(spark):
    df = spark.createDataFrame([("IoT/water/W1",), ("IoT/energy/Airconditioning/HVAC2",)], "topic STRING")
    assert [r[0] for r in df.select(sensor_from_topic("topic")).collect()] == ["W1", "HVAC2"]


def test_raw_envelope_drops_what_float_rejects(spark):
    m = spark.createDataFrame([
        ("IoT/water/W1", "2023-01-01 00:15:00 | 0.5"),
        ("IoT/water/W1", "2022-12-22 05:03:00 | 0.44f"),  # flagged: float() fails
        ("IoT/temperature/TH1", "2023-01-01 00:15:00 | 21.3"),
        ("IoT/movement/Mov1", "2023-01-01 00:15:00 | 1"),
        ("IoT/energy/Etot", "bad"),
    ], "topic STRING, payload STRING")
    rows = {(r.Sensor, r.DateTime, r.value, r.domain) for r in raw_envelope(m).collect()}
    assert rows == {("W1", "2023-01-01 00:15:00", 0.5, "water"),
                    ("TH1", "2023-01-01 00:15:00", 21.3, "temp"),
                    ("Mov1", "2023-01-01 00:15:00", 1.0, "temp")}


def test_ingest_types_the_time_field(spark):
    m = messages(spark, ["2023-01-01 00:15:00 | 42.5"])
    row = ingest_raw(m).collect()[0]
    assert row.DateTime == ts("2023-01-01 00:15:00") and row.domain == "energy"


def test_json_roundtrip_and_formats(spark):
    df = spark.createDataFrame([("2023-01-02 00:00:00", 4.5)], "d STRING, v DOUBLE").select(
        F.to_timestamp("d").alias("Day"), F.to_date("d").alias("D"), F.col("v").alias("Total"))
    enc = encode_json(df)
    text = enc.collect()[0].value
    assert text == '{"Day":"2023-01-02T00:00:00.000Z","D":"2023-01-02","Total":4.5}'
    back = decode_json(enc, "Day TIMESTAMP, D DATE, Total DOUBLE")
    assert back.collect() == df.collect()


def test_format_payload_matches_device_text(spark):
    df = spark.createDataFrame([("2023-01-01 00:15:00", 42.5)], "t STRING, v DOUBLE")
    out = df.select(format_payload(F.to_timestamp("t"), "v").alias("p"),
                    format_payload(F.to_timestamp("t"), "v", F.lit(True)).alias("f")).collect()[0]
    assert out.p == "2023-01-01 00:15:00 | 42.5"
    assert out.f == "2023-01-01 00:15:00 | 42.5f"


def test_ingest_routes_rejects_with_reason(spark):
    m = spark.createDataFrame([
        ("IoT/water/W1", "2023-01-01 00:15:00 | 0.5"),
        ("IoT/water/W1", "2022-12-22 05:03:00 | 0.44f"),
        ("IoT/energy/Etot", "bad"),
        ("IoT/temperature/TH1", "yesterday | 21.3"),
    ], "topic STRING, payload STRING")
    env, rej = ingest_raw(m, with_rejects=True)
    assert env.count() == 1
    assert sorted((r.payload, r.reason) for r in rej.collect()) == [
        ("2022-12-22 05:03:00 | 0.44f", "bad value"), ("bad", "no separator"),
        ("yesterday | 21.3", "bad time")]
    assert env.count() + rej.count() == m.count()


def _py_float(t):
    try:
        return float(t)
    except ValueError:
        return None


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-.eEf ", max_size=8), min_size=1, max_size=200))
def test_strict_double_follows_python_float(spark, texts):
    from gridsense.functions.parse import strict_double
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r.v for r in df.select(strict_double("t").alias("v")).collect()]
    assert got == [_py_float(t) for t in texts]
