"""Stateful operators with a watermark of each key's own, over one scan.

Spark's watermark belongs to a query: keys that are out of step lose rows, or
need one scan each. Here each key (a sensor) keeps its own: the latest event
time it has sent, less ``delay``. As with Spark's, what a micro-batch may add is
judged by the watermark at the batch's start.

* :func:`keyed_rollup`: tumbling sums. A window leaves once, when its key's
  watermark passes its end; readings of windows that have left come out at the
  side as ``late`` rows (X8), summed like the others: accepted, late and open
  readings together are all readings. State: the open windows of each key.
* :func:`keyed_counter_diff`: daily differences of counters, revised as readings
  arrive. State: the first reading of the last ``keep_days`` days of each
  counter, however long it runs.

Before the shuffle each task sums the readings of a window to one row (the first
reading of a day, for counters), so a key with a third of all rows sends a few
rows per task to the one task that holds its state. All of a key's state is one
row of the state store; reading and writing it is one call per key and batch.

These queries need the RocksDB state store; :func:`rocksdb` sets it while a
query starts (a restarted query finds it in its checkpoint). :func:`open_windows`
reads the state back as a table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridsense.operators.rollup import EXACT

ACCEPTED, LATE = "accepted", "late"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY = 86_400_000_000  # microseconds
_HELD = 100_000  # partial rows a task holds before it sums them again

# Spark initialises a stateful processor in a Python process of its own beside
# the driver, which need not find this package: processors are sent whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started inside use the RocksDB state store."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def micros(spark: SparkSession, interval: str) -> int:
    """Microseconds of an interval like ``"3 days"``."""
    start = F.lit("1970-01-01").cast("timestamp")
    return spark.range(1).select(F.unix_micros(start + F.expr(f"INTERVAL {interval}")) - F.unix_micros(start)).first()[0]


def _summed(df: DataFrame, keys: list[str], aggs: list[tuple[str, str]]) -> DataFrame:
    """Rows of a task with equal ``keys`` as one (column, aggregate) row; a
    partial aggregate, repeated rows of a key may leave a task."""
    names = df.columns

    def fold(tables: list[pa.Table]) -> pa.Table:
        got = pa.concat_tables(tables).group_by(keys).aggregate(aggs)
        return got.rename_columns({f"{c}_{f}": c for c, f in aggs}).select(names).cast(tables[0].schema)

    def run(batches):
        held, rows = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(pa.Table.from_batches([b]))
            held[-1] = fold([held[-1]])
            rows += held[-1].num_rows
            if rows > _HELD:
                held = [fold(held)]
                rows = held[0].num_rows
                if rows > _HELD // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from fold(held).to_batches()

    return df.mapInArrow(run, df.schema)


class _Windows(StatefulProcessor):
    """Sums of the open windows of a key; its latest event time."""

    SCHEMA = "mark LONG, win ARRAY<LONG>, exact ARRAY<DECIMAL(38,8)>, plain ARRAY<DOUBLE>, n ARRAY<LONG>, n_exact ARRAY<LONG>"

    def __init__(self, period: int, delay: int, keys: list[str]):
        self.period, self.delay, self.keys = period, delay, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("windows", self.SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark, open_ = None, {}
        if self.state.exists():
            mark, *lists = self.state.get()
            open_ = {w: sums for w, *sums in zip(*lists)}
        closed = None if mark is None else mark - self.delay
        late: dict = {}
        for pdf in rows:
            for w, t, *sums in pdf[["win", "t", "exact", "plain", "n", "n_exact"]].itertuples(index=False, name=None):
                into = late if closed is not None and w + self.period <= closed else open_
                into[w] = [a + b for a, b in zip(into[w], sums)] if w in into else sums
                mark = t if mark is None or t > mark else mark
        gone = sorted(w for w in open_ if w + self.period <= mark - self.delay)
        out = [(ACCEPTED, w, *open_.pop(w)) for w in gone] + [(LATE, w, *late[w]) for w in sorted(late)]
        kept = [[w, *open_[w]] for w in sorted(open_)]
        self.state.update((int(mark), *([type_(x) for x in col] for type_, col in zip(
            (int, Decimal, float, int, int), zip(*kept) if kept else [[]] * 5))))
        if out:
            cols = pd.DataFrame(out, columns=["kind", "win", "exact", "plain", "n", "n_exact"])
            for k, v in zip(self.keys, key):
                cols.insert(0, k, v)
            yield cols

    def close(self) -> None:
        pass


def _total(round_to: int | None, by: str, average) -> Column:
    """Sum of a window (mean, for the keys in ``average``): in decimals where
    all its readings have one."""
    mean = F.col(by).isin(list(average))
    exact = F.when(mean, F.col("exact").cast(EXACT) / F.col("n").cast("decimal(12,0)")).otherwise(F.col("exact"))
    plain = F.when(mean, F.col("plain") / F.col("n")).otherwise(F.col("plain"))
    if round_to is not None:
        exact, plain = F.round(exact, round_to), F.round(plain, round_to)
    return F.when(F.col("n") == F.col("n_exact"), exact.cast("double")).otherwise(plain)


def _window_rows(df: DataFrame, ts: str, value: str, keys: list[str], period: int) -> DataFrame:
    t = F.unix_micros(F.col(ts))
    exact = F.col(value).try_cast(EXACT).cast("decimal(38,8)")
    return df.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        *keys, (t - F.pmod(t, F.lit(period))).alias("win"), t.alias("t"),
        F.coalesce(exact, F.lit(0).cast("decimal(38,8)")).alias("exact"), F.col(value).alias("plain"),
        F.lit(1).cast("long").alias("n"), F.when(exact.isNull(), 0).otherwise(1).cast("long").alias("n_exact"))


def keyed_rollup(df: DataFrame, delay: str, period: str = "1 day", ts: str = "DateTime", value: str = "NumVal",
                 by: str = "Sensor", label: str = "Day", out: str = "Total", round_to: int | None = 2,
                 average=()) -> DataFrame:
    """``(by, kind, label, out, n)`` of a stream of readings: sums of windows of
    ``period`` (cut at the epoch) that the key's own watermark has passed, once
    each, as ``kind = "accepted"``; and, once per batch, the sums of readings of
    windows that had left before, as ``kind = "late"``. ``n`` counts readings.
    Of the keys in ``average`` the mean is given in place of the sum.
    Readings without a time or a value, or of a null key, take no part."""
    spark = df.sparkSession
    width, wait = micros(spark, period), micros(spark, delay)
    rows = _window_rows(df.where(F.col(by).isNotNull()), ts, value, [by], width)
    partial = _summed(rows, [by, "win"], [("t", "max"), ("exact", "sum"), ("plain", "sum"), ("n", "sum"), ("n_exact", "sum")])
    kind = df.schema[by].dataType.simpleString()
    found = partial.groupBy(by).transformWithStateInPandas(
        _Windows(width, wait, [by]), f"`{by}` {kind}, kind STRING, win LONG, exact DECIMAL(38,8), plain DOUBLE, "
                                     "n LONG, n_exact LONG", "append", "None")
    return found.select(by, "kind", F.timestamp_micros(F.col("win") + width).alias(label),
                        _total(round_to, by, average).alias(out), "n")


def open_windows(spark: SparkSession, checkpoint: str, period: str = "1 day", by: str = "Sensor", label: str = "Day",
                 out: str = "Total", round_to: int | None = 2, average=()) -> DataFrame:
    """The windows that a :func:`keyed_rollup` query still holds open, from its
    checkpoint's state: ``(by, label, out, n)`` (X10)."""
    state = spark.read.format("statestore").option("stateVarName", "windows").load(checkpoint)
    held = state.select(F.col(f"key.{by}").alias(by), F.explode(F.arrays_zip(
        *[F.col(f"value.{c}").alias(c) for c in ("win", "exact", "plain", "n", "n_exact")])).alias("w")).select(by, "w.*")
    return held.select(by, F.timestamp_micros(F.col("win") + micros(spark, period)).alias(label),
                       _total(round_to, by, average).alias(out), "n")


class _Counter(StatefulProcessor):
    """The first readings of a counter's last days."""

    SCHEMA = "mark LONG, day ARRAY<LONG>, t ARRAY<LONG>, v ARRAY<DOUBLE>"

    def __init__(self, keep_days: int, key: str, ttl_ms: int | None):
        self.keep, self.key, self.ttl = keep_days, key, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("firsts", self.SCHEMA, self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark, first = None, {}
        if self.state.exists():
            mark, *lists = self.state.get()
            first = {d: (t, v) for d, t, v in zip(*lists)}
        changed = set()
        for pdf in rows:
            for d, t, v in pdf[["day", "t", "v"]].itertuples(index=False, name=None):
                if mark is not None and d <= mark - self.keep:
                    continue  # older than what is held
                if d not in first or (t, v) < first[d]:
                    first[d] = (t, v)
                    changed |= {d, d + 1}
        if first:
            newest = max(first)
            mark = newest if mark is None else max(mark, newest)
        out = [(d, first[d][1] - first[d - 1][1]) for d in sorted(changed) if d in first and d - 1 in first]
        kept = [(d, *first[d]) for d in sorted(first) if d > mark - self.keep]
        if kept:
            days, times, values = zip(*kept)
            self.state.update((int(mark), [int(x) for x in days], [int(x) for x in times], [float(x) for x in values]))
        if out:
            cols = pd.DataFrame(out, columns=["day", "diff"])
            cols.insert(0, self.key, key[0])
            yield cols

    def close(self) -> None:
        pass


def keyed_counter_diff(df: DataFrame, keep_days: int = 7, ts: str = "DateTime", value: str = "NumVal",
                       by: str = "Sensor", label: str = "Day", out: str = "daily_diff", round_to: int | None = 2,
                       ttl_ms: int | None = None) -> DataFrame:
    """``(by, label, out)`` of a stream of counter readings, in update mode: the
    first reading of a day less that of the day before, as
    :func:`~gridsense.operators.counter.counter_daily_diff` gives pairs, again
    whenever one of the two changes. A reading more than ``keep_days`` days behind
    its counter's newest is left out. ``ttl_ms``: the state of a counter that is
    silent so long (in processing time) goes; such a query runs on and needs a
    trigger by processing time."""
    t = F.unix_micros(F.col(ts))
    rows = df.where(F.col(by).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        by, F.floor(t / DAY).cast("long").alias("day"), t.alias("t"), F.col(value).alias("v"))
    names = rows.columns

    def firsts(batches):
        for b in batches:
            got = pa.Table.from_batches([b]).sort_by([(by, "ascending"), ("day", "ascending"), ("t", "ascending"),
                                                      ("v", "ascending")])
            first = got.group_by([by, "day"], use_threads=False).aggregate([("t", "first"), ("v", "first")])
            yield from first.rename_columns({"t_first": "t", "v_first": "v"}).select(names).cast(got.schema).to_batches()

    kind = df.schema[by].dataType.simpleString()
    found = rows.mapInArrow(firsts, rows.schema).groupBy(by).transformWithStateInPandas(
        _Counter(keep_days, by, ttl_ms), f"`{by}` {kind}, day LONG, diff DOUBLE", "update",
        "ProcessingTime" if ttl_ms else "None")
    diff = F.col("diff") if round_to is None else F.round("diff", round_to)
    return found.select(by, F.timestamp_micros(F.col("day") * DAY).alias(label), diff.alias(out))
