"""Tumbling-window roll-ups: daily sum / average, 10-minute rejected sums.

Each roll-up is one ``groupBy(keys, window)`` with algebraic aggregates, so
Spark plans a partial (map-side) aggregate before the shuffle: a sensor that
holds a third of all rows still sends one partial row per map task and day,
never its raw rows. With ``delay`` the same plan runs as a watermarked
streaming aggregate whose state is evicted once a window closes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sums and averages are taken in decimals, so that they do not depend on the
# order in which readings meet (a double sum's last digit does, and can tip a
# rounding).
EXACT = "decimal(28,8)"


def _sum_or_avg(f, value: str, round_to: int | None) -> Column:
    exact = F.col(value).try_cast(EXACT)
    taken = f(exact) if round_to is None else F.round(f(exact), round_to)
    plain = f(value) if round_to is None else F.round(f(value), round_to)
    # A value that has no such decimal (not finite, or beyond 1e20) makes the
    # window's result an ordinary double one.
    return F.when(F.count(exact) == F.count(value), taken.cast("double")).otherwise(plain)


def _plain(f):
    return lambda value, round_to: f(value) if round_to is None else F.round(f(value), round_to)


_AGGS = {
    "sum": lambda value, round_to: _sum_or_avg(F.sum, value, round_to),
    "avg": lambda value, round_to: _sum_or_avg(F.avg, value, round_to),
    "min": _plain(F.min),
    "max": _plain(F.max),
    "count": lambda value, round_to: F.count(value),
}


def _keys(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def watermark(df: DataFrame, ts: str, delay: str, by=None, each=None) -> DataFrame:
    """Watermark a stream on ``ts``.

    With ``each`` (values of the single key column ``by``) every key gets its
    own watermark: the stream is split per key and united again. Spark then
    advances the query by the slowest key (``min`` policy), so a sensor
    lagging the others by more than ``delay`` loses no rows — the
    reference's one watermark per topic — at the price of windows closing at
    the pace of the slowest sensor; a listed key that never reports keeps all
    windows open. Keys not listed are left out.
    """
    if each is None:
        return df.withWatermark(ts, delay)
    keys = _keys(by)
    if len(keys) != 1:
        raise ValueError("a watermark per key needs exactly one key column")
    parts = [df.where(F.col(keys[0]) == F.lit(v)).withWatermark(ts, delay) for v in each]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def window_rollup(df: DataFrame, period: str, aggs: dict[str, Column],
                  ts: str = "DateTime", by=None, delay: str | None = None,
                  label: str = "Day", label_at: str = "end", watermark_each=None,
                  nonempty: str | None = None) -> DataFrame:
    """Aggregate over tumbling windows of ``period``; the window becomes one
    timestamp column ``label`` (its end by default, as the reference labels
    days). ``watermark_each`` lists key values that get a watermark each
    (see :func:`watermark`). ``nonempty`` names a value column: windows
    without any non-NULL value of it are left out, after the aggregation
    (rows without a time never reach a window)."""
    keys = _keys(by)
    if delay is not None:
        df = watermark(df, ts, delay, by, watermark_each)
    agg_cols = [c.alias(name) for name, c in aggs.items()]
    if nonempty is not None:
        agg_cols.append(F.count(nonempty).alias("_n"))
    out = df.groupBy(*keys, F.window(ts, period)).agg(*agg_cols)
    if nonempty is not None:
        out = out.where(F.col("_n") > 0)
    return out.select(*keys, F.col(f"window.{label_at}").alias(label), *aggs.keys())


def daily_rollup(df: DataFrame, how: str | Sequence[str] = "sum", ts: str = "DateTime",
                 value: str = "NumVal", by=None, out: str | Sequence[str] | None = None,
                 delay: str | None = None, round_to: int | None = 2,
                 period: str = "1 day", label: str = "Day", watermark_each=None) -> DataFrame:
    """Daily ``sum`` / ``avg`` (or min, max, count) of a reading, labelled by
    the end of the day window: readings of 01-01 give ``Day = 01-02 00:00``.

    ``how`` may be a list to compute several aggregates in the same pass;
    ``out`` names the result columns (default ``Total`` for one aggregate,
    else the aggregate names). ``by`` keys the roll-up (e.g. ``Sensor``), so
    all sensors share one shuffle; in a stream they then share one watermark
    unless ``watermark_each`` lists the sensors to watermark one by one.
    """
    hows = [how] if isinstance(how, str) else list(how)
    if out is None:
        outs = ["Total"] if len(hows) == 1 else hows
    else:
        outs = [out] if isinstance(out, str) else list(out)
    if len(outs) != len(hows):
        raise ValueError("one output name per aggregate")
    aggs = {}
    for h, name in zip(hows, outs):
        if h not in _AGGS:
            raise ValueError(f"unknown roll-up {h!r}")
        aggs[name] = _AGGS[h](value, round_to)
    return window_rollup(df, period, aggs, ts=ts, by=by, delay=delay, label=label,
                         watermark_each=watermark_each, nonempty=value)


def rejected_rollup(df: DataFrame, ts: str = "DateTime", value: str = "NumVal", by=None,
                    period: str = "10 minutes", delay: str | None = None,
                    label: str = "RejectedEvent", out: str = "RejectedVal",
                    round_to: int | None = None) -> DataFrame:
    """Sum of rejected-late readings per 10-minute window, labelled by the
    window end. Unrounded, as the reference emits it."""
    return window_rollup(df, period, {out: _sum_or_avg(F.sum, value, round_to)}, ts=ts, by=by,
                         delay=delay, label=label, nonempty=value)


def plausible(df: DataFrame, col: str, lt: float | None = None, gt: float | None = None) -> DataFrame:
    """Keep rows whose ``col`` lies strictly inside the given bounds.

    The reference uses such bounds to hide results it knows to be incomplete
    (an unpaired counter reading, a partial day in update mode); the bounds
    depend on the data, so none has a default.
    """
    if lt is None and gt is None:
        raise ValueError("give lt and/or gt")
    cond = F.lit(True)
    if lt is not None:
        cond = cond & (F.col(col) < F.lit(lt))
    if gt is not None:
        cond = cond & (F.col(col) > F.lit(gt))
    return df.where(cond)
