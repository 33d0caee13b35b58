"""The driver's ``events`` table as household sensor streams.

``events(event_id, ts, user_id, event_type, value, props)`` stands in for
the device layer: each event type is a sensor, each row one reading, and
the message text is made exactly as a device formats it. A cumulative
counter is derived from the daily totals of two of the sensors, so that its
daily differences (and hence the leak) can be checked against the table
itself. Every row of the table is used; rows are only ever routed (e.g.
to the rejected stream), never dropped to save work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridsense.functions.parse import format_payload
from gridsense.registry import Sensor, map_literal

# The stand-in sensors, their topics, domains and roll-ups.
EVENT_SENSORS = (
    Sensor("click", "IoT/water/click", "water", "gauge", "sum"),
    Sensor("view", "IoT/water/view", "water", "gauge", "sum"),
    Sensor("purchase", "IoT/energy/purchase", "energy", "gauge", "sum"),
    Sensor("signup", "IoT/energy/signup", "energy", "gauge", "sum"),
    Sensor("error", "IoT/temperature/error", "temp", "gauge", "avg"),
    Sensor("motion", "IoT/movement/motion", "temp", "flag", "sum"),
    Sensor("meter", "IoT/water/meter", "water", "counter", "diff"),
    Sensor("etot", "IoT/energy/etot", "energy", "counter", "diff"),
    Sensor("wtot", "IoT/water/wtot", "water", "counter", "diff"),
)
AVERAGED = tuple(s.name for s in EVENT_SENSORS if s.how == "avg")
SUB_METER = "click"  # the W1 role: a sub-meter whose stream carries late rows
COUNTER = "meter"  # the Wtot role: read once a day at midnight
COUNTER_PARTS = ("click", "view")  # the meter totals these two sensors
# Counters whose daily step does not grow with the table (the Etot and Wtot
# roles): the day's average event value so many times.
STEADY = {"etot": 96, "wtot": 1}
MOTION = "motion"  # 0/1 per event, 1 for a signup (the Mov1 role)
MOTION_SOURCE = "signup"
# Every 120th reading of the sub-meter is flagged late (the simulator's rate
# of 10-day-late rows). The flag only routes the row to the rejected stream.
LATE_EVERY = 120


def _topic_of(sensor_col):
    """The topic of an event type; one that is not listed has its own, so it
    is read like the others."""
    known = F.try_element_at(map_literal((s.name, s.topic) for s in EVENT_SENSORS), sensor_col)
    return F.coalesce(known, F.concat(F.lit("IoT/other/"), sensor_col))


def load_events(spark: SparkSession, sf_dir: str, stream: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` table; ``stream=True`` opens it as a file stream with
    the batch schema.

    A table that is a folder of part files is streamed as it is; a table that
    is one file is streamed as its parent folder, filtered to that file.
    """
    path = f"{sf_dir}/events.parquet"
    table = spark.read.parquet(path)
    if not stream:
        return table
    r = spark.readStream.schema(table.schema)
    if max_files_per_trigger is not None:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    files = table.inputFiles()
    if len(files) == 1 and files[0].rstrip("/").endswith("/events.parquet"):
        return r.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return r.parquet(path)


def late_flag() -> F.Column:
    return (F.col("event_type") == F.lit(SUB_METER)) & (F.col("event_id") % LATE_EVERY == 0)


def messages_of(events: DataFrame, flag_late: bool = True) -> DataFrame:
    """Rows of the table as ``(topic, payload)`` device messages."""
    flag = late_flag() if flag_late else None
    return events.select(_topic_of(F.col("event_type")).alias("topic"),
                         format_payload("ts", "value", flag).alias("payload"))


def event_messages(spark: SparkSession, sf_dir: str, sensors=None,
                   flag_late: bool = True, motion: bool = False,
                   stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """``(topic, payload)`` device messages of the given gauge sensors, of
    every event type when ``sensors`` is None.

    ``flag_late`` appends the late flag to the sub-meter's flagged rows;
    ``motion`` adds the 0/1 motion stream (one reading per event);
    ``stream`` gives a streaming DataFrame over the table.
    """
    ev = load_events(spark, sf_dir, stream, max_files_per_trigger)
    if not motion:
        known = F.col("event_type").isNotNull() if sensors is None else F.col("event_type").isin(list(sensors))
        return messages_of(ev.where(known), flag_late)
    flag = late_flag() if flag_late else None
    topic = _topic_of(F.col("event_type")).alias("topic")
    payload = format_payload("ts", "value", flag).alias("payload")
    # Both messages of an event from one scan of the table: a gauge reading
    # (when its type is a listed sensor) and the 0/1 motion reading.
    mv = F.when(F.col("event_type") == MOTION_SOURCE, 1.0).otherwise(0.0)
    moved = F.struct(_topic_of(F.lit(MOTION)).alias("topic"), format_payload("ts", mv).alias("payload"))
    cands = [moved]
    if sensors is None:
        cands.insert(0, F.when(F.col("event_type").isNotNull(), F.struct(topic, payload)))
    elif sensors:
        cands.insert(0, F.when(F.col("event_type").isin(list(sensors)), F.struct(topic, payload)))
    return ev.select(F.explode(F.array(*cands)).alias("m")).where(F.col("m").isNotNull()) \
        .select("m.topic", "m.payload")


def counter_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(Sensor, DateTime, NumVal)``: the meter read at each midnight.

    The reading at day label D (midnight) is the running total, in exact
    decimals, of the two part sensors over all days before D. The running
    sum is over the daily totals: the one counter has one row per day, so its
    window, a single task, holds days and never raw readings.
    """
    ev = load_events(spark, sf_dir).where(F.col("event_type").isin(list(COUNTER_PARTS)))
    daily = ev.groupBy(F.window("ts", "1 day").end.alias("label")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("tot"))
    w = Window.partitionBy("Sensor").orderBy("label")
    return (daily.withColumn("Sensor", F.lit(COUNTER))
            .select("Sensor", F.col("label").alias("DateTime"),
                    F.sum("tot").over(w).cast("double").alias("NumVal")))


def steady_readings(spark: SparkSession, sf_dir: str, sensor: str) -> DataFrame:
    """``(Sensor, DateTime, NumVal)`` of a steady counter, read at each
    midnight: each day adds the day's average event value :data:`STEADY` times,
    so a daily difference has the size of one household's, however many
    events there are. Averages are taken in whole cents, so sums are exact."""
    ev = load_events(spark, sf_dir)
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    daily = ev.groupBy(F.window("ts", "1 day").end.alias("label")).agg(
        (F.floor(cents / F.count("value")) * STEADY[sensor]).cast("long").alias("tot"))
    w = Window.partitionBy("Sensor").orderBy("label")
    return (daily.withColumn("Sensor", F.lit(sensor))
            .select("Sensor", F.col("label").alias("DateTime"),
                    (F.sum("tot").over(w) / 100).cast("double").alias("NumVal")))


def reading_messages(readings: DataFrame) -> DataFrame:
    """``(Sensor, DateTime, NumVal)`` as device messages ``(topic, payload)``."""
    return readings.select(_topic_of(F.col("Sensor")).alias("topic"),
                           format_payload("DateTime", "NumVal").alias("payload"))


def steady_messages(spark: SparkSession, sf_dir: str, sensor: str) -> DataFrame:
    """A steady counter's readings as device messages."""
    return reading_messages(steady_readings(spark, sf_dir, sensor))


def counter_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The meter readings as device messages."""
    return reading_messages(counter_readings(spark, sf_dir))
