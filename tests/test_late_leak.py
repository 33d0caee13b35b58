import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridsense.functions.parse import parse_reading
from gridsense.operators.late import split_late
from gridsense.operators.leak import latest_per_key, leak
from gridsense.operators.rollup import rejected_rollup
from tests.conftest import messages, ts


def _w1(spark, payloads):
    return parse_reading(messages(spark, payloads, "IoT/water/W1"), numeric=False)


def test_flagged_rows_rejected_none_accepted(spark):
    acc, rej = split_late(_w1(spark, ["2022-12-22 05:03:00 | 0.44f", "2022-12-22 05:08:00 | 0.5f"]))
    assert acc.count() == 0
    out = rejected_rollup(rej).collect()
    assert [(r.RejectedEvent, r.RejectedVal) for r in out] == [(ts("2022-12-22 05:10:00"), 0.94)]


def test_flag_tested_before_cast(spark):
    acc, rej = split_late(_w1(spark, ["2023-01-01 00:15:00 | 0.5", "2023-01-01 00:30:00 | 0.44f"]))
    assert [r.NumVal for r in acc.collect()] == [0.5]
    assert [r.NumVal for r in rej.collect()] == [0.44]


def test_null_value_in_neither_branch(spark):
    acc, rej = split_late(_w1(spark, ["2023-01-01 00:15:00"]))
    assert acc.count() == 0 and rej.count() == 0


def test_arrival_rule(spark):
    df = spark.createDataFrame(
        [("2023-01-10 00:00:00", "2023-01-10 00:05:00", 1.0),
         ("2023-01-01 00:00:00", "2023-01-11 00:00:00", 2.0),
         ("2023-01-08 00:00:00", "2023-01-10 00:00:00", 3.0)],
        "t STRING, a STRING, v DOUBLE").select(
        F.to_timestamp("t").alias("DateTime"), F.to_timestamp("a").alias("arrived"), F.col("v").alias("Val"))
    acc, rej = split_late(df, rule="arrival", arrival="arrived", delay="3 days")
    assert sorted(r.NumVal for r in acc.collect()) == [1.0, 3.0]
    assert [r.NumVal for r in rej.collect()] == [2.0]


def _day_rows(spark, rows, col, schema_extra=""):
    df = spark.createDataFrame(rows, f"d STRING, v DOUBLE{schema_extra}")
    return df.select(F.to_timestamp("d").alias("Day"), F.col("v").alias(col),
                     *([F.col("b").alias("batch_id")] if schema_extra else []))


def test_leak_value(spark):
    sub = _day_rows(spark, [("2023-01-02 00:00:00", 52.0)], "Totalw1")
    tot = _day_rows(spark, [("2023-01-02 00:00:00", 112.0)], "daily_diff")
    assert [tuple(r) for r in leak(sub, tot).collect()] == [(ts("2023-01-02 00:00:00"), 60.0)]


def test_leak_unmatched_day_gives_no_row(spark):
    sub = _day_rows(spark, [("2023-01-02 00:00:00", 52.0)], "Totalw1")
    tot = _day_rows(spark, [("2023-01-03 00:00:00", 112.0)], "daily_diff")
    assert leak(sub, tot).count() == 0


def test_revisions_later_kept(spark):
    revs = _day_rows(spark, [("2023-01-02 00:00:00", 30.0, 0), ("2023-01-02 00:00:00", 52.0, 1),
                             ("2023-01-03 00:00:00", 41.0, 1)], "Totalw1", ", b LONG")
    out = sorted(tuple(r) for r in latest_per_key(revs, "Day", "batch_id").collect())
    assert out == [(ts("2023-01-02 00:00:00"), 52.0), (ts("2023-01-03 00:00:00"), 41.0)]


def test_leak_over_revisions_gives_one_row_per_day(spark):
    sub = _day_rows(spark, [("2023-01-02 00:00:00", 30.0, 0), ("2023-01-02 00:00:00", 52.0, 1)],
                    "Totalw1", ", b LONG")
    tot = _day_rows(spark, [("2023-01-02 00:00:00", 112.0, 0)], "daily_diff", ", b LONG")
    out = [tuple(r) for r in leak(sub, tot, revision="batch_id").collect()]
    assert out == [(ts("2023-01-02 00:00:00"), 60.0)]


def test_leak_several_sub_meters(spark):
    sub = spark.createDataFrame([("2023-01-02 00:00:00", "HVAC1", 10.0), ("2023-01-02 00:00:00", "MiAC1", 20.5)],
                                "d STRING, s STRING, v DOUBLE") \
        .select(F.to_timestamp("d").alias("Day"), F.col("s").alias("Sensor"), F.col("v").alias("Total"))
    tot = _day_rows(spark, [("2023-01-02 00:00:00", 100.0)], "daily_diff")
    out = leak(sub, tot, sub="Total", sum_subs=True).collect()
    assert [r.LeakValue for r in out] == [69.5]


def test_split_late_rejects_unknown_rule(spark):
    df = _w1(spark, ["2023-01-01 00:15:00 | 0.5"])
    with pytest.raises(ValueError):
        split_late(df, rule="guess")
    with pytest.raises(ValueError):
        split_late(df, rule="arrival")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 40), st.floats(-1e6, 1e6, allow_nan=False)),
                min_size=1, max_size=80, unique_by=lambda r: (r[0], r[1])))
def test_latest_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k INT, batch_id LONG, v DOUBLE").repartition(3)
    got = {r.k: r.v for r in latest_per_key(df, "k", "batch_id").collect()}
    want = {}
    for k, b, v in sorted(rows, key=lambda r: r[1]):
        want[k] = v
    assert got == want
