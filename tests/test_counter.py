import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from gridsense.operators.counter import SINGLE_VALUE, VALDIFF_SQL, counter_daily_diff
from gridsense.operators.rollup import plausible
from tests.conftest import readings, ts

ROWS = [("2023-01-01 00:00:00", 110.5), ("2023-01-02 00:00:00", 215.25),
        ("2023-01-03 00:00:00", 330.0)]
EXPECTED = [(ts("2023-01-02 00:00:00"), 104.75), (ts("2023-01-03 00:00:00"), 114.75)]


def _result(df):
    return sorted((r.Day, r.daily_diff) for r in df.collect())


def test_pairs_only(spark):
    assert _result(counter_daily_diff(readings(spark, ROWS))) == EXPECTED


def test_reverse_order_same_result(spark):
    df = readings(spark, list(reversed(ROWS))).repartition(3)
    assert _result(counter_daily_diff(df)) == EXPECTED


def test_single_reading_reported_as_reference_does(spark):
    out = _result(counter_daily_diff(readings(spark, ROWS), single=SINGLE_VALUE))
    assert out == [(ts("2023-01-01 00:00:00"), 110.5), *EXPECTED, (ts("2023-01-04 00:00:00"), 330.0)]
    hidden = _result(plausible(counter_daily_diff(readings(spark, ROWS), single=SINGLE_VALUE),
                               "daily_diff", lt=150))
    assert hidden == [(ts("2023-01-01 00:00:00"), 110.5), *EXPECTED]


def test_date_label_unrounded(spark):
    df = counter_daily_diff(readings(spark, ROWS[:2]), round_to=None, day_type="date")
    row = df.collect()[0]
    assert row.Day == dt.date(2023, 1, 2) and row.daily_diff == 215.25 - 110.5


def test_duplicate_delivery_is_not_a_pair(spark):
    rows = [ROWS[0], ROWS[0]]
    assert counter_daily_diff(readings(spark, rows)).count() == 0


def test_keyed_counters(spark):
    a = readings(spark, ROWS, "Etot")
    b = readings(spark, [("2023-01-01 00:00:00", 10.0), ("2023-01-02 00:00:00", 11.0)], "Wtot")
    out = {(r.Sensor, r.Day, r.daily_diff) for r in counter_daily_diff(a.unionByName(b), by="Sensor").collect()}
    assert out == {("Etot", *EXPECTED[0]), ("Etot", *EXPECTED[1]), ("Wtot", ts("2023-01-02 00:00:00"), 1.0)}


def test_sql_form(spark):
    readings(spark, ROWS[:2]).createOrReplaceTempView("ctr")
    expr = VALDIFF_SQL.format(v="NumVal", t="DateTime")
    assert spark.sql(f"SELECT {expr} AS d FROM ctr").collect()[0].d == 104.75


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=500, allow_nan=False), min_size=2, max_size=8),
       st.randoms())
def test_order_independence(spark, increments, rnd):
    total, rows = 0.0, []
    for i, inc in enumerate(increments):
        total = round(total + inc, 2)
        rows.append(((dt.datetime(2023, 1, 1) + dt.timedelta(days=i)).isoformat(sep=" "), total))
    expected = _result(counter_daily_diff(readings(spark, rows)))
    shuffled = rows[:]
    random.Random(rnd.random()).shuffle(shuffled)
    got = _result(counter_daily_diff(readings(spark, shuffled).repartition(4)))
    assert got == expected
    assert len(expected) == len(rows) - 1


def test_more_readings_a_day_change_nothing(spark):
    rows = [(f"2023-01-{d:02d} {h:02d}:00:00", 240.0 * d + 10 * h) for d in range(1, 5) for h in (0, 6, 12, 18)]
    got = _result(counter_daily_diff(readings(spark, rows)))
    assert [v for _, v in got] == [240.0, 240.0, 240.0]


def test_equal_instants_take_the_smaller_value(spark):
    rows = [("2023-01-01 00:00:00", 5.0), ("2023-01-01 00:00:00", 7.0), ("2023-01-02 00:00:00", 9.0)]
    assert [v for _, v in _result(counter_daily_diff(readings(spark, rows)))] == [4.0]
