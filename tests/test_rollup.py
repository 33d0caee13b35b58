import pytest
from pyspark.sql import functions as F

from gridsense.operators.rollup import daily_rollup, plausible, rejected_rollup, window_rollup
from gridsense.plans.jobs import gauge_daily
from tests.conftest import readings, ts


def test_daily_sum_labelled_by_day_end(spark):
    r = readings(spark, [("2023-01-01 00:15:00", 1.5), ("2023-01-01 08:00:00", 1.5),
                         ("2023-01-01 23:45:00", 1.5)])
    assert [tuple(x) for x in daily_rollup(r).collect()] == [(ts("2023-01-02 00:00:00"), 4.5)]


def test_daily_average_rounded(spark):
    r = readings(spark, [("2023-01-01 01:00:00", 12.0), ("2023-01-01 02:00:00", 13.0),
                         ("2023-01-01 03:00:00", 14.01)])
    assert daily_rollup(r, how="avg").collect()[0].Total == 13.0


def test_midnight_belongs_to_next_day(spark):
    r = readings(spark, [("2023-01-02 00:00:00", 1.0)])
    assert daily_rollup(r).collect()[0].Day == ts("2023-01-03 00:00:00")


def test_keyed_rollup_several_aggregates(spark):
    r = readings(spark, [("2023-01-01 01:00:00", 1.0), ("2023-01-01 02:00:00", 2.0)], "A") \
        .unionByName(readings(spark, [("2023-01-01 01:00:00", 5.0)], "B"))
    out = {(x["Sensor"], x["sum"], x["avg"], x["count"]) for x in
           daily_rollup(r, how=["sum", "avg", "count"], by="Sensor").collect()}
    assert out == {("A", 3.0, 1.5, 2), ("B", 5.0, 5.0, 1)}


def test_gauge_daily_picks_sum_or_avg_per_sensor(spark):
    r = readings(spark, [("2023-01-01 01:00:00", 20.0), ("2023-01-01 02:00:00", 22.0)], "TH1") \
        .unionByName(readings(spark, [("2023-01-01 01:00:00", 10.0), ("2023-01-01 02:00:00", 5.0)], "HVAC1"))
    out = {(x.Sensor, x.Total) for x in gauge_daily(r).collect()}
    assert out == {("TH1", 21.0), ("HVAC1", 15.0)}


def test_rejected_ten_minute_windows(spark):
    r = readings(spark, [("2022-12-22 05:03:00", 0.44), ("2022-12-22 05:08:00", 0.5),
                         ("2022-12-22 05:10:00", 0.1)])
    out = sorted(tuple(x) for x in rejected_rollup(r).collect())
    assert out == [(ts("2022-12-22 05:10:00"), 0.94), (ts("2022-12-22 05:20:00"), 0.1)]


def test_plausible_bounds(spark):
    r = readings(spark, [("2023-01-01 01:00:00", 30.0), ("2023-01-02 01:00:00", 50.0)])
    d = daily_rollup(r, out="Totalw1")
    assert [x.Totalw1 for x in plausible(d, "Totalw1", gt=40).collect()] == [50.0]
    assert [x.Totalw1 for x in plausible(d, "Totalw1", lt=40).collect()] == [30.0]
    with pytest.raises(ValueError):
        plausible(d, "Totalw1")


def test_window_label_at_start_and_argument_checks(spark):
    r = readings(spark, [("2023-01-01 05:00:00", 1.0)])
    out = window_rollup(r, "1 day", {"n": F.count("NumVal")}, label="Start", label_at="start")
    assert [tuple(x) for x in out.collect()] == [(ts("2023-01-01 00:00:00"), 1)]
    with pytest.raises(ValueError):
        daily_rollup(r, how=["sum", "avg"], out="Total")
    with pytest.raises(ValueError):
        daily_rollup(r, how="median")


def test_unknown_sensor_is_summed(spark):
    r = readings(spark, [("2023-01-01 01:00:00", 2.0), ("2023-01-01 02:00:00", 4.0)], "X9")
    assert [x.Total for x in gauge_daily(r).collect()] == [6.0]


def test_unparseable_readings_leave_no_trace(spark):
    from gridsense.plans.jobs import sensor_readings
    from tests.conftest import messages
    m = messages(spark, ["2023-01-01 01:00:00 | 1.5", "2023-01-01 02:00:00 | x", "bad",
                         "2023-01-05 02:00:00 | y", "junk | 7.0"])
    out = [tuple(r) for r in daily_rollup(sensor_readings(m, valid_only=False), by="Sensor").collect()]
    assert out == [("HVAC1", ts("2023-01-02 00:00:00"), 1.5)]
