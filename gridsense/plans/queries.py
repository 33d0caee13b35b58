"""The registered queries: one per operator group of the household
application, each over the driver's tables at ``sf_dir``, plus the
equivalent DuckDB SQL over the same tables.

Timestamps leave these queries as ``TIMESTAMP_NTZ`` (UTC wall-clock), the
type DuckDB gives the same columns. Streaming queries run to completion over
the data available now (``availableNow``) and return their sink as a batch
DataFrame. Those in update mode give every window; the one in append mode
(``stream_daily_sum``) leaves out the windows its watermark still holds open,
as the reference's does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridsense.functions.parse import decode_json, encode_json, raw_envelope
from gridsense.functions.sql import register
from gridsense.operators.counter import SINGLE_VALUE, counter_daily_diff
from gridsense.operators.late import split_late
from gridsense.operators.leak import latest_per_key, leak, leak_of_revisions
from gridsense.operators.rollup import daily_rollup, plausible, rejected_rollup
from gridsense.plans import jobs
from gridsense.session import ensure_utc, new_work_path
from gridsense.sources import events as ev
from gridsense.sources.io import read_dataset, read_messages, read_topic, write_messages
from gridsense.streaming import keyed
from gridsense.streaming.progress import ProgressLog
from gridsense.streaming.sinks import (REVISION, read_revisions, run_available, run_available_together,
                                      start_topic_sink, wait_for)

# Bounds of the reference's plausibility filters (Etot below
# 72000 and Wtot below 150 per day, W1 above 40 per day).
COUNTER_LT = 72000.0
WATER_LT = 150.0
SUB_GT = 40.0
# Watermark delays of the reference's streams (gauges, W1).
GAUGE_DELAY = "1 second"
ACCEPT_DELAY = "3 days"
# The dashboard-style range read by the panel query.
PANEL_START = "2024-01-03 00:00:00"
PANEL_END = "2024-01-08 00:00:00"
LATE_SPLIT = "2024-01-20 00:00:00"  # where the late-rows query parts its stream
PARTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")  # where others part theirs, in three
HELD_BACK = "2024-01-09 00:00:00"  # a counter reading that comes with the second part
AHEAD = "60 days"  # how far one gauge is ahead of the others
JOIN_DELAY = "5 seconds"  # fixed value: the reference's watermark on both sides of its join
AVG_SENSOR = "error"  # the stand-in sensor averaged per day (TH1 / TH2 role)

Query = Callable[[SparkSession, str], DataFrame]


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


# -- building blocks shared by several queries ---------------------------------

def _sub_readings(msgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) readings of the sub-meter."""
    flagged = jobs.sensor_readings(msgs, [ev.SUB_METER], numeric=False)
    return split_late(flagged)


def _accepted_daily(accepted: DataFrame, delay: str | None = None, by=None) -> DataFrame:
    d = daily_rollup(accepted, by=by, delay=delay, out="Totalw1")
    return plausible(d, "Totalw1", gt=SUB_GT)


def _counter_pairs(readings: DataFrame, delay: str | None = None) -> DataFrame:
    return counter_daily_diff(readings, by="Sensor", delay=delay)


# -- batch queries --------------------------------------------------------------

def parse_reading_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, flag_late=False)
    r = jobs.sensor_readings(msgs, valid_only=False)
    return r.select("Sensor", _ntz("DateTime"), "NumVal")


def raw_envelope_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return raw_envelope(ev.event_messages(spark, sf_dir), sensors=ev.EVENT_SENSORS)


def json_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    env = raw_envelope(ev.event_messages(spark, sf_dir), sensors=ev.EVENT_SENSORS)
    records = encode_json(env, ["Sensor", "DateTime", "value", "domain"])
    back = decode_json(records, "Sensor STRING, DateTime STRING, value DOUBLE, domain STRING")
    return back.select("Sensor", F.try_to_timestamp("DateTime").cast("timestamp_ntz").alias("DateTime"),
                       "value", "domain")


def _one_gauge_daily(spark: SparkSession, sf_dir: str, sensor: str, how: str,
                     motion: bool = False) -> DataFrame:
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, sensors=() if motion else (sensor,),
                             flag_late=False, motion=motion)
    r = jobs.sensor_readings(msgs, [sensor])
    return daily_rollup(r, how=how).select(_ntz("Day"), "Total")


def daily_sum_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_gauge_daily(spark, sf_dir, "purchase", "sum")


def daily_avg_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_gauge_daily(spark, sf_dir, AVG_SENSOR, "avg")


def movement_sum_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_gauge_daily(spark, sf_dir, ev.MOTION, "sum", motion=True)


def daily_by_sensor_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, flag_late=False, motion=True)
    d = jobs.gauge_daily(jobs.sensor_readings(msgs), ev.EVENT_SENSORS)
    return d.select("Sensor", _ntz("Day"), "Total")


def counter_diff_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    r = jobs.sensor_readings(ev.counter_messages(spark, sf_dir))
    return _counter_pairs(r).select("Sensor", _ntz("Day"), "daily_diff")


def counter_diff_threshold_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's Etot form: a single reading reports itself, the
    difference is unrounded and labelled by a DATE, and a bound hides the
    running total of an unpaired last reading."""
    ensure_utc(spark)
    r = jobs.sensor_readings(ev.steady_messages(spark, sf_dir, "etot"))
    d = counter_daily_diff(r, by="Sensor", single=SINGLE_VALUE, day_type="date")
    return plausible(d, "daily_diff", lt=COUNTER_LT)


def energy_job_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The energy application: daily sums of its gauges and the difference
    of its counter, as one list of results."""
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, flag_late=False).unionByName(ev.steady_messages(spark, sf_dir, "etot"))
    out = jobs.energy_job(msgs, COUNTER_LT, ev.EVENT_SENSORS)
    diff = out["counter_diff"].select("Sensor", F.col("Day").cast("timestamp").alias("Day"),
                                      F.round("daily_diff", 2).alias("Total"))
    return out["daily"].unionByName(diff).select("Sensor", _ntz("Day"), "Total")


def temp_job_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temperature application: daily averages and the movement count."""
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, flag_late=False, motion=True)
    return jobs.temp_job(msgs, ev.EVENT_SENSORS)["daily"].select("Sensor", _ntz("Day"), "Total")


def water_job_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The water application: accepted daily sums, rejected sums and the
    difference of the water counter under its bound, as one list."""
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,)) \
        .unionByName(ev.steady_messages(spark, sf_dir, "wtot"))
    out = jobs.water_job(msgs, SUB_GT, WATER_LT, sub_meters=(ev.SUB_METER,), counters=("wtot",),
                         sensors=ev.EVENT_SENSORS)
    parts = [out[name].select(F.lit(name).alias("result"), F.col(at).alias("At"), F.round(value, 2).alias("Value"))
             for name, at, value in (("accepted_daily", "Day", "Totalw1"), ("counter_diff", "Day", "daily_diff"),
                                     ("rejected", "RejectedEvent", "RejectedVal"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("result", _ntz("At"), "Value")


def late_by_arrival_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late routing by arrival time: a reading that arrives more than the
    accepted lateness after its own time is rejected. Every 120th reading of
    the sub-meter (the flagged ones) arrives 10 days late."""
    ensure_utc(spark)
    rows = ev.load_events(spark, sf_dir).where(F.col("event_type") == ev.SUB_METER)
    arrival = F.when(ev.late_flag(), F.col("ts").cast("timestamp") + F.expr("INTERVAL 10 DAYS")) \
        .otherwise(F.col("ts").cast("timestamp"))
    r = rows.select(F.col("ts").cast("timestamp").alias("DateTime"), F.col("value").alias("NumVal"),
                    arrival.alias("Arrival"))
    accepted, rejected = split_late(r, value="NumVal", rule="arrival", arrival="Arrival", delay=ACCEPT_DELAY)
    out = daily_rollup(accepted, out="Total").withColumn("late", F.lit(False)).unionByName(
        daily_rollup(rejected, out="Total").withColumn("late", F.lit(True)))
    return out.select("late", _ntz("Day"), "Total")


def accepted_daily_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    accepted, _ = _sub_readings(ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,)))
    return _accepted_daily(accepted).select(_ntz("Day"), "Totalw1")


def rejected_10min_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    _, rejected = _sub_readings(ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,)))
    return rejected_rollup(rejected).select(_ntz("RejectedEvent"), "RejectedVal")


def leak_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    accepted, _ = _sub_readings(ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,)))
    sub = _accepted_daily(accepted)
    total = _counter_pairs(jobs.sensor_readings(ev.counter_messages(spark, sf_dir)))
    return leak(sub, total).select(_ntz("Day"), "LeakValue")


def _hourly_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions ``(Day, batch_id, Totalw1)`` of the sub-meter's daily sum as
    an update-mode stream emits them when each hour of data is one batch."""
    accepted, _ = _sub_readings(ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,)))
    hourly = accepted.groupBy(F.window("DateTime", "1 day").end.alias("Day"),
                              F.date_trunc("hour", "DateTime").alias("hour")) \
        .agg(F.sum(F.col("NumVal").cast("decimal(28,8)")).alias("s"))
    upto = Window.partitionBy("Day").orderBy("hour")
    return hourly.select("Day", (F.unix_timestamp("hour") / 3600).cast("long").alias(REVISION),
                         F.round(F.sum("s").over(upto), 2).cast("double").alias("Totalw1"))


def latest_per_day_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of a day's hourly revisions is its final sum."""
    ensure_utc(spark)
    return latest_per_key(_hourly_revisions(spark, sf_dir), "Day", REVISION, ["Totalw1"]) \
        .select(_ntz("Day"), "Totalw1")


def panel_sensor_range_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ingest of every stream into the store, then a panel's read of one
    sensor over a time range (partition pruning + pushed range filter)."""
    ensure_utc(spark)
    root = new_work_path(spark, "store")
    env = jobs.ingest_raw(ev.event_messages(spark, sf_dir, motion=True), sensors=ev.EVENT_SENSORS)
    jobs.store_raw(env, f"{root}/raw")
    df = read_dataset(spark, f"{root}/raw", sensor=ev.SUB_METER, start=PANEL_START, end=PANEL_END)
    return df.select("Sensor", _ntz("DateTime"), "value", "domain")


def panel_clustered_range_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same read from the layout for very many sensors: no folder per
    sensor, rows clustered by sensor and time, skipped by statistics."""
    ensure_utc(spark)
    root = new_work_path(spark, "store")
    env = jobs.ingest_raw(ev.event_messages(spark, sf_dir, motion=True), sensors=ev.EVENT_SENSORS)
    jobs.store_raw(env, f"{root}/raw", clustered=True)
    df = read_dataset(spark, f"{root}/raw", sensor=ev.SUB_METER, start=PANEL_START, end=PANEL_END)
    return df.select("Sensor", _ntz("DateTime"), "value", "domain")


def counter_diff_sql_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counter's difference called by name from SQL."""
    ensure_utc(spark)
    register(jobs.sensor_readings(ev.counter_messages(spark, sf_dir)))
    return spark.sql(f"SELECT * FROM counter_diff('{ev.COUNTER}')").select("Sensor", _ntz("Day"), "daily_diff")


def panel_daily_avg_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily roll-ups of every sensor kept as a dataset, then the
    dashboard's daily-average panel for one averaged sensor and range."""
    ensure_utc(spark)
    root = new_work_path(spark, "store")
    msgs = ev.event_messages(spark, sf_dir, flag_late=False, motion=True)
    jobs.store_daily(jobs.gauge_daily(jobs.sensor_readings(msgs), ev.EVENT_SENSORS),
                     f"{root}/daily")
    df = jobs.panel(spark, root, "th2_daily_avg", start=PANEL_START, end=PANEL_END,
                    sensor=AVG_SENSOR)
    return df.select("Sensor", _ntz("Day"), "Total")


# -- streaming queries ----------------------------------------------------------

def _stream_of(spark: SparkSession, messages: DataFrame, name: str) -> DataFrame:
    """Store derived messages (a counter's) as a source folder and open it
    as a stream; device messages are streamed from the table itself."""
    path = write_messages(messages, new_work_path(spark, f"{name}-src"))
    return read_messages(spark, path, stream=True)


def stream_daily_sum_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, flag_late=False, motion=True, stream=True)
    daily = jobs.gauge_daily(jobs.sensor_readings(msgs), ev.EVENT_SENSORS,
                             delay=GAUGE_DELAY)
    out = run_available(daily, new_work_path(spark, "daily-out"))
    return spark.read.parquet(out).select("Sensor", _ntz("Day"), "Total")


def stream_accepted_update_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,), stream=True)
    accepted, _ = _sub_readings(msgs)
    daily = _accepted_daily(accepted, delay=ACCEPT_DELAY)
    out = run_available(daily, new_work_path(spark, "w1-rev"), mode="update")
    return read_revisions(spark, out, ["Day"]).select(_ntz("Day"), "Totalw1")


def _late_rows_runs(spark: SparkSession, sf_dir: str):
    """Three runs of the sub-meter's stream: its readings up to
    :data:`LATE_SPLIT`, those after it, and last every 50th of the first part,
    days late: (results, the queries that ran)."""
    rows = ev.load_events(spark, sf_dir).where(F.col("event_type") == ev.SUB_METER)
    early, late = F.col("ts") < F.lit(LATE_SPLIT).cast("timestamp_ntz"), F.col("event_id") % 50 == 0
    src, out, started = new_work_path(spark, "late-src"), new_work_path(spark, "late-out"), []
    for part in (early & ~late, ~early, early & late):
        write_messages(ev.messages_of(rows.where(part), flag_late=False), src)
        msgs = read_messages(spark, src, stream=True)
        daily = daily_rollup(jobs.sensor_readings(msgs), delay=ACCEPT_DELAY, out="Totalw1")
        started.append(start_topic_sink(daily, out, mode="update", trigger={"availableNow": True}))
        wait_for(started[-1:])
    return out, started


def stream_late_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows behind the 3-day watermark, over three runs of one stream. Late rows
    of windows that the watermark has closed are dropped; those of open ones are
    added."""
    ensure_utc(spark)
    out, _ = _late_rows_runs(spark, sf_dir)
    return read_revisions(spark, out, ["Day"]).select(_ntz("Day"), "Totalw1")


def stream_rejected_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected-late readings of the sub-meter, 10-minute sums, streamed in
    update mode without a watermark, as the reference's."""
    ensure_utc(spark)
    msgs = ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,), stream=True)
    _, rejected = _sub_readings(msgs)
    out = run_available(rejected_rollup(rejected), new_work_path(spark, "rejected-out"), mode="update")
    return read_revisions(spark, out, ["RejectedEvent"]).select(_ntz("RejectedEvent"), "RejectedVal")


def stream_counter_diff_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    msgs = _stream_of(spark, ev.counter_messages(spark, sf_dir), "meter")
    diff = _counter_pairs(jobs.sensor_readings(msgs))
    out = run_available(diff, new_work_path(spark, "meter-out"), mode="update")
    return read_revisions(spark, out, ["Sensor", "Day"]).select("Sensor", _ntz("Day"), "daily_diff")


def _leak_topics(spark: SparkSession, sf_dir: str) -> str:
    """The two topics the leak needs, as update-mode streams side by side."""
    root = new_work_path(spark, "leak")
    w1 = ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,), stream=True)
    accepted, _ = _sub_readings(w1)
    meter = _stream_of(spark, ev.counter_messages(spark, sf_dir), "meter")
    sub = _accepted_daily(accepted.withColumn("Sensor", F.lit(ev.SUB_METER)), delay=ACCEPT_DELAY, by="Sensor")
    run_available_together([
        (sub, f"{root}/accepted_daily", {"fmt": "json", "mode": "update"}),
        (_counter_pairs(jobs.sensor_readings(meter)), f"{root}/counter_diff", {"fmt": "json", "mode": "update"}),
    ])
    return root


def stream_leak_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stages coupled by JSON topics, as the reference couples its water
    and leak applications: (1) the sub-meter's accepted daily sums and the
    counter's differences, both in update mode, side by side; (2) the leak of
    the two topics' revisions, again as a stream in update mode."""
    ensure_utc(spark)
    root = _leak_topics(spark, sf_dir)
    jobs.start_leak(spark, root, pairs=((ev.SUB_METER, ev.COUNTER),), trigger={"availableNow": True}).awaitTermination()
    rows = read_revisions(spark, f"{root}/leak", jobs.KEYS["leak"], json_schema=jobs.TOPIC_SCHEMAS["leak"])
    return rows.select(_ntz("Day"), "LeakValue")


def _three_parts(df: DataFrame, ts: str) -> list[DataFrame]:
    """Rows before, between and after :data:`PARTS`."""
    a, b = (F.lit(t).cast("timestamp_ntz") for t in PARTS)
    t = F.col(ts).cast("timestamp_ntz")
    return [df.where(t < a), df.where((t >= a) & (t < b)), df.where(t >= b)]


def stream_leak_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's chain as it stands: daily sums and counter differences
    leave in append mode as JSON topics, a second application joins the two
    streams on the day, both sides watermarked, and appends to a third topic,
    which is read back typed. Three parts of the data arrive one after the
    other; the join runs after each and holds what it has not matched. The
    outer form also gives the sub-meter's days that have no meter."""
    ensure_utc(spark)
    root = new_work_path(spark, "join")
    clicks = ev.load_events(spark, sf_dir).where(F.col("event_type") == ev.SUB_METER)
    meter = ev.counter_readings(spark, sf_dir)
    for sub_part, meter_part in zip(_three_parts(clicks, "ts"), _three_parts(meter, "DateTime")):
        write_messages(ev.messages_of(sub_part), f"{root}/sub-src")
        write_messages(ev.reading_messages(meter_part), f"{root}/meter-src")
        accepted, _ = _sub_readings(read_messages(spark, f"{root}/sub-src", stream=True))
        counter = jobs.sensor_readings(read_messages(spark, f"{root}/meter-src", stream=True))
        run_available_together([
            (_accepted_daily(accepted, delay=ACCEPT_DELAY), f"{root}/sub", {"fmt": "json"}),
            (counter_daily_diff(counter, delay=GAUGE_DELAY), f"{root}/total", {"fmt": "json"}),
        ])
        joined = leak(read_topic(spark, f"{root}/sub", jobs.SUB_SCHEMA, stream=True),
                      read_topic(spark, f"{root}/total", jobs.TOTAL_SCHEMA, stream=True),
                      watermark=JOIN_DELAY, how="left")
        run_available(joined, f"{root}/leak", fmt="json")
    rows = read_topic(spark, f"{root}/leak", "Day TIMESTAMP, Totalw1 DOUBLE, LeakValue DOUBLE")
    return rows.select(_ntz("Day"), "Totalw1", "LeakValue")


def _run_keyed(df: DataFrame, out: str, **kw) -> None:
    """Run a stream of :mod:`keyed` operators over what is there."""
    with keyed.rocksdb(df.sparkSession):
        started = start_topic_sink(df, out, trigger={"availableNow": True}, **kw)
    wait_for([started])


def stream_keyed_daily_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gauge's days from one scan, each gauge with a watermark of its
    own: the sub-meter's readings come first and are 60 days ahead of all
    others, which lose nothing by it."""
    ensure_utc(spark)
    root = new_work_path(spark, "keyed")
    rows = ev.load_events(spark, sf_dir)
    sub = F.col("event_type") == ev.SUB_METER
    ahead = rows.where(sub).withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {AHEAD}"))
    for part in (ahead, rows.where(~sub)):
        write_messages(ev.messages_of(part, flag_late=False), f"{root}/src")
        readings = jobs.sensor_readings(read_messages(spark, f"{root}/src", stream=True))
        daily = keyed.keyed_rollup(readings, GAUGE_DELAY, average=ev.AVERAGED)
        _run_keyed(daily, f"{root}/daily", partition_by=["kind"])
    rows = spark.read.parquet(f"{root}/daily")
    return rows.select("Sensor", "kind", _ntz("Day"), "Total", "n")


def _late_runs(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Three runs of the sub-meter's stream under the accepted lateness, the
    last with readings that are days behind: the folder of its results."""
    rows = ev.load_events(spark, sf_dir).where(F.col("event_type") == ev.SUB_METER)
    early, late = F.col("ts") < F.lit(LATE_SPLIT).cast("timestamp_ntz"), F.col("event_id") % 50 == 0
    root = new_work_path(spark, name)
    for part in (early & ~late, ~early, early & late):
        write_messages(ev.messages_of(rows.where(part), flag_late=False), f"{root}/src")
        readings = jobs.sensor_readings(read_messages(spark, f"{root}/src", stream=True))
        _run_keyed(keyed.keyed_rollup(readings, ACCEPT_DELAY), f"{root}/out", partition_by=["kind"])
    return f"{root}/out"


def stream_late_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows routed by the watermark itself: days that it has closed, the
    readings that came after (as sums, like the rejected ones), and the days
    still open, read from the query's state. Together they are all readings."""
    ensure_utc(spark)
    out = _late_runs(spark, sf_dir, "late-split")
    closed = spark.read.parquet(out).select("kind", "Day", "Total", "n")
    open_ = keyed.open_windows(spark, f"{out}.checkpoint").select(F.lit("open").alias("kind"), "Day", "Total", "n")
    return closed.unionByName(open_).select("kind", _ntz("Day"), "Total", "n")


def stream_open_windows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a running roll-up as a table: the sub-meter's open days."""
    ensure_utc(spark)
    out = _late_runs(spark, sf_dir, "open")
    return keyed.open_windows(spark, f"{out}.checkpoint").select("Sensor", _ntz("Day"), "Total", "n")


def stream_counter_state_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differences of all counters with a state of a few days each, in three
    parts; a reading of the first part comes with the second."""
    ensure_utc(spark)
    root = new_work_path(spark, "counter-state")
    rows = ev.counter_readings(spark, sf_dir)
    for sensor in ev.STEADY:
        rows = rows.unionByName(ev.steady_readings(spark, sf_dir, sensor))
    held = F.col("DateTime").cast("timestamp_ntz") == F.lit(HELD_BACK).cast("timestamp_ntz")
    first, second, third = _three_parts(rows, "DateTime")
    for part in (first.where(~held), second.unionByName(first.where(held)), third):
        write_messages(ev.reading_messages(part), f"{root}/src")
        readings = jobs.sensor_readings(read_messages(spark, f"{root}/src", stream=True))
        _run_keyed(keyed.keyed_counter_diff(readings), f"{root}/out", mode="update")
    return read_revisions(spark, f"{root}/out", ["Sensor", "Day"]).select("Sensor", _ntz("Day"), "daily_diff")


def leak_revisions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leak over two revision logs in batch: hourly revisions of the
    sub-meter's daily sums, two revisions of the counter's differences."""
    ensure_utc(spark)
    total = _counter_pairs(jobs.sensor_readings(ev.counter_messages(spark, sf_dir)))
    first = total.select("Day", F.lit(0.0).alias("daily_diff"), F.lit(0).cast("long").alias(REVISION))
    total = first.unionByName(total.select("Day", "daily_diff", F.lit(1).cast("long").alias(REVISION)))
    sub = plausible(_hourly_revisions(spark, sf_dir), "Totalw1", gt=SUB_GT)
    return leak_of_revisions(sub, total, REVISION).select(_ntz("Day"), "LeakValue")


def _household(spark: SparkSession, sf_dir: str, runs: int = 1) -> tuple[str, str]:
    """The whole streaming application on the stand-in sensors, topics and
    store, run to its end ``runs`` times: (topics, store)."""
    root = new_work_path(spark, "household")
    once = {"availableNow": True}
    counters = ev.counter_messages(spark, sf_dir).unionByName(ev.steady_messages(spark, sf_dir, "etot")) \
        .unionByName(ev.steady_messages(spark, sf_dir, "wtot"))
    src = write_messages(counters, new_work_path(spark, "counters-src"))
    for _ in range(runs):
        device = ev.event_messages(spark, sf_dir, motion=True, stream=True)
        msgs = device.unionByName(read_messages(spark, src, stream=True))
        for stage in (
                lambda: jobs.start_household(msgs, f"{root}/topics", sensors=ev.EVENT_SENSORS,
                                             late_sensors=(ev.SUB_METER,), accept_delay=ACCEPT_DELAY,
                                             sub_gt=SUB_GT, trigger=once)
                + [jobs.start_raw_store(msgs, f"{root}/store", ev.EVENT_SENSORS, trigger=once)],
                lambda: [jobs.start_leak(spark, f"{root}/topics", pairs=((ev.SUB_METER, ev.COUNTER),), trigger=once)],
                lambda: jobs.start_store(spark, f"{root}/topics", f"{root}/store", trigger=once)):
            wait_for(stage())
    return f"{root}/topics", f"{root}/store"


def stream_household_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole application: stage one (keyed queries over one message
    stream), the leak stage, and the leak read back from its topic."""
    ensure_utc(spark)
    topics, _ = _household(spark, sf_dir)
    rows = read_revisions(spark, f"{topics}/leak", jobs.KEYS["leak"], json_schema=jobs.TOPIC_SCHEMAS["leak"])
    return rows.select("Meter", _ntz("Day"), "LeakValue")


def store_twice_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole application with its store, run twice: rows of every stored
    dataset, which the second run must leave as they are."""
    ensure_utc(spark)
    _, store = _household(spark, sf_dir, runs=2)
    out = None
    for name in jobs.RESULTS:
        n = jobs.read_store(spark, store, name).agg(F.count(F.lit(1)).alias("n"))
        n = n.select(F.lit(name).alias("dataset"), "n")
        out = n if out is None else out.unionByName(n)
    raw = read_dataset(spark, f"{store}/raw").agg(F.count(F.lit(1)).alias("n"))
    return out.unionByName(raw.select(F.lit("raw").alias("dataset"), "n"))


def stream_progress_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the watermark drops, counted: the rows behind it of
    :func:`stream_late_rows_q`, from the log of the queries' progress (Spark
    counts windows of a batch that had closed)."""
    ensure_utc(spark)
    log = ProgressLog(spark, new_work_path(spark, "progress"))
    started = _late_rows_runs(spark, sf_dir)[1]
    rows = log.close(started).where(F.col("run_id").isin([str(q.runId) for q in started]))
    return rows.agg(F.sum("input_rows").alias("input_rows"), F.sum("dropped_by_watermark").alias("dropped"))


def _panel_store(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    """A store with one dataset, made by the streams that it needs."""
    root, once = new_work_path(spark, "panel"), {"availableNow": True}
    topics, store = f"{root}/topics", f"{root}/store"
    if dataset == "raw":
        msgs = ev.event_messages(spark, sf_dir, motion=True, stream=True)
        wait_for([jobs.start_raw_store(msgs, store, ev.EVENT_SENSORS, trigger=once)])
        return store
    if dataset == "rejected":
        _, rejected = _sub_readings(ev.event_messages(spark, sf_dir, sensors=(ev.SUB_METER,), stream=True))
        run_available(rejected_rollup(rejected, by="Sensor"), f"{topics}/rejected", fmt="json", mode="update")
    elif dataset == "counter_diff":
        counters = ev.steady_messages(spark, sf_dir, "etot").unionByName(ev.steady_messages(spark, sf_dir, "wtot"))
        diff = _counter_pairs(jobs.sensor_readings(_stream_of(spark, counters, "counters")))
        run_available(diff, f"{topics}/counter_diff", fmt="json", mode="update")
    elif dataset == "leak":
        topics = _leak_topics(spark, sf_dir)
        wait_for([jobs.start_leak(spark, topics, pairs=((ev.SUB_METER, ev.COUNTER),), trigger=once)])
    wait_for(jobs.start_store(spark, topics, store, names=[dataset], trigger=once))
    return store


def _panel_q(name: str, sensor: str | None, value: str):
    """A panel's rows from a store with its dataset."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        store = _panel_store(spark, sf_dir, jobs.PANELS[name][0])
        df = jobs.panel(spark, store, name, start=PANEL_START, end=PANEL_END, sensor=sensor)
        key, at = ("Meter" if name == "water_leak" else "Sensor"), jobs.PANELS[name][2]
        return df.select(F.col(key).alias("Sensor"), F.col(at).cast("timestamp_ntz").alias("At"),
                         F.round(value, 2).alias("Value"))
    return run


QUERIES: dict[str, Query] = {
    "parse_reading": parse_reading_q,
    "raw_envelope": raw_envelope_q,
    "json_roundtrip": json_roundtrip_q,
    "daily_sum": daily_sum_q,
    "daily_avg": daily_avg_q,
    "movement_sum": movement_sum_q,
    "daily_by_sensor": daily_by_sensor_q,
    "counter_diff": counter_diff_q,
    "counter_diff_threshold": counter_diff_threshold_q,
    "counter_diff_sql": counter_diff_sql_q,
    "energy_job": energy_job_q,
    "temp_job": temp_job_q,
    "water_job": water_job_q,
    "accepted_daily": accepted_daily_q,
    "late_by_arrival": late_by_arrival_q,
    "rejected_10min": rejected_10min_q,
    "leak": leak_q,
    "leak_revisions": leak_revisions_q,
    "latest_per_day": latest_per_day_q,
    "panel_sensor_range": panel_sensor_range_q,
    "panel_clustered_range": panel_clustered_range_q,
    "panel_daily_avg": panel_daily_avg_q,
    "panel_th1_raw": _panel_q("th1_raw", AVG_SENSOR, "value"),
    "panel_w1_raw": _panel_q("w1_raw", ev.SUB_METER, "value"),
    "panel_late_rejected": _panel_q("late_rejected", ev.SUB_METER, "RejectedVal"),
    "panel_etot_diff": _panel_q("etot_diff", "etot", "daily_diff"),
    "panel_water_leak": _panel_q("water_leak", ev.COUNTER, "LeakValue"),
    "stream_daily_sum": stream_daily_sum_q,
    "stream_accepted_update": stream_accepted_update_q,
    "stream_late_rows": stream_late_rows_q,
    "stream_progress": stream_progress_q,
    "stream_rejected": stream_rejected_q,
    "stream_counter_diff": stream_counter_diff_q,
    "stream_leak": stream_leak_q,
    "stream_leak_join": stream_leak_join_q,
    "stream_keyed_daily": stream_keyed_daily_q,
    "stream_late_split": stream_late_split_q,
    "stream_open_windows": stream_open_windows_q,
    "stream_counter_state": stream_counter_state_q,
    "stream_household": stream_household_q,
    "store_twice": store_twice_q,
}
