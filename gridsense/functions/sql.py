"""The counter's difference as SQL objects (U2).

``register`` makes two functions of the session, in SQL alone:

* ``val_diff(readings)``: the last less the first value of an array of
  ``(time, value)``, by time: ``SELECT val_diff(collect_list(struct(t, v)))``;
* ``counter_diff(of_sensor)``: a table function over the registered readings;
  ``SELECT * FROM counter_diff('Etot')``, or ``counter_diff(NULL)`` for all. Its
  rows are those of :func:`~gridsense.operators.counter.counter_daily_diff`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

VAL_DIFF = """
CREATE OR REPLACE TEMPORARY FUNCTION val_diff(readings ARRAY<STRUCT<t: TIMESTAMP, v: DOUBLE>>)
RETURNS DOUBLE
RETURN element_at(array_sort(filter(readings, r -> r.v IS NOT NULL)), -1).v
     - element_at(array_sort(filter(readings, r -> r.v IS NOT NULL)), 1).v"""

# The first reading of each day; each is the later one of its own label and the
# earlier one of the next, so a label's pair meets in a grouped maximum.
COUNTER_DIFF = """
CREATE OR REPLACE TEMPORARY FUNCTION counter_diff(of_sensor STRING)
RETURNS TABLE (Sensor STRING, Day TIMESTAMP, daily_diff DOUBLE)
RETURN
  WITH firsts AS (
    SELECT r.Sensor AS s, to_date(r.DateTime) AS d, min(struct(r.DateTime, r.NumVal)).NumVal AS v
    FROM {view} r
    WHERE r.NumVal IS NOT NULL AND r.DateTime IS NOT NULL AND (of_sensor IS NULL OR r.Sensor = of_sensor)
    GROUP BY r.Sensor, to_date(r.DateTime)),
  sides AS (
    SELECT s, d, v AS later, CAST(NULL AS DOUBLE) AS earlier FROM firsts
    UNION ALL SELECT s, date_add(d, 1), NULL, v FROM firsts)
  SELECT s, to_timestamp(d), round(max(later) - max(earlier), 2)
  FROM sides GROUP BY s, d HAVING max(later) IS NOT NULL AND max(earlier) IS NOT NULL"""


def register(readings: DataFrame, view: str = "gridsense_readings") -> None:
    """Make the functions over ``readings (Sensor, DateTime, NumVal)``, which
    get the temporary view ``view``."""
    spark = readings.sparkSession
    readings.createOrReplaceTempView(view)
    spark.sql(VAL_DIFF)
    spark.sql(COUNTER_DIFF.format(view=view))
