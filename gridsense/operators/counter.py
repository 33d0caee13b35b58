"""Daily difference of a cumulative counter (Etot, Wtot).

The windows are 2 days long and slide by 1 day. The window ``[D-1, D+1)``
pairs the first reading of day ``D-1`` with the first reading of day ``D``; its
label ``end - 1 day = D`` is the day the consumption ends, the same label a
tumbling day window ``[D-1, D)`` gets, so counters and gauges join on it. A
counter read once a day at midnight, as the reference's are, has just these
two readings in a window; further readings of a day change nothing.

The reference computes the difference with an order-dependent fold. Here the
two readings are found by event time (``min`` of time and value), which is
order independent and algebraic: Spark aggregates partially before the
shuffle, and in a stream the state per window is two readings and a count. Of
different values at the same instant the smallest counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.operators.rollup import _keys

# How a window holding a single reading is reported.
SINGLE_DROP = "drop"  # left out: only true pairs give a difference
SINGLE_VALUE = "value"  # the reading itself (value - 0), as the reference emits it


def counter_daily_diff(df: DataFrame, ts: str = "DateTime", value: str = "NumVal", by=None,
                       delay: str | None = None, single: str = SINGLE_DROP,
                       round_to: int | None = 2, day_type: str = "timestamp",
                       out: str = "daily_diff", label: str = "Day",
                       keep_count: bool = False) -> DataFrame:
    """``(keys, Day, daily_diff)`` from counter readings ``(ts, value)``.

    * ``single="drop"``: windows without a reading on both days are left out.
    * ``single="value"``: such a window reports the reading itself; combine
      with :func:`~gridsense.operators.rollup.plausible` to hide the ones
      above a bound, as the reference does.
    * ``day_type``: ``"timestamp"`` (midnight, UTC) or ``"date"``.
    * ``delay``: watermark for streams (required in append mode; the
      reference keeps this state forever).
    """
    if single not in (SINGLE_DROP, SINGLE_VALUE):
        raise ValueError(f"single must be {SINGLE_DROP!r} or {SINGLE_VALUE!r}")
    keys = _keys(by)
    if delay is not None:
        df = df.withWatermark(ts, delay)
    # A reading without a value is ignored inside the aggregates (its time
    # orders nothing) rather than by a filter, which Spark would push below
    # the parsing and so parse every message twice.
    w = df.select(*keys, F.window(ts, "2 days", "1 day").alias("window"), F.col(ts).alias("_t"),
                  F.col(value).alias("_v"))
    reading = F.struct("_t", "_v")
    later = F.col("_t") >= F.col("window.start") + F.expr("INTERVAL 1 DAY")
    g = w.groupBy(*keys, "window").agg(
        F.min(F.when(F.col("_v").isNotNull() & ~later, reading)).alias("_before"),
        F.min(F.when(F.col("_v").isNotNull() & later, reading)).alias("_after"),
        F.count("_v").alias("n"))
    # A pair means a reading on each of the two days: readings delivered twice
    # (at-least-once transport) are no pair.
    paired = F.col("_before").isNotNull() & F.col("_after").isNotNull()
    diff = F.col("_after._v") - F.col("_before._v")
    if single == SINGLE_DROP:
        g = g.where(paired)
    else:
        g = g.where(F.col("n") > 0)
        diff = F.when(paired, diff).otherwise(F.coalesce(F.col("_after._v"), F.col("_before._v")))
    if round_to is not None:
        diff = F.round(diff, round_to)
    day = F.date_sub(F.col("window.end"), 1)
    if day_type == "timestamp":
        day = F.to_timestamp(day)
    elif day_type != "date":
        raise ValueError("day_type is 'timestamp' or 'date'")
    cols = [*keys, day.alias(label), diff.alias(out)]
    if keep_count:
        cols.append("n")
    return g.select(*cols)


# The same difference as SQL text, for users of spark.sql (the reference
# registers its fold under the name ValDiff).
VALDIFF_SQL = "max_by({v}, {t}) - min_by({v}, {t})"
