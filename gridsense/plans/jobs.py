"""Composite jobs of the household application, batch or streaming.

The reference runs one streaming query per sensor and aggregate (twelve in
four applications). Here a domain job takes one message DataFrame holding
many topics and rolls all its gauges up in one keyed aggregate, so a
single shuffle serves all sensors of the domain. The same functions accept a
batch DataFrame (a replay, a back-fill) or a streaming one.

Store layout under a root folder (one dataset per collection, see
:data:`LAYOUT`):

=================  =====================================  ==============
dataset            columns                                partitions
=================  =====================================  ==============
``raw``            Sensor, DateTime, value, domain        domain, Sensor, month
``daily``          Sensor, Day, Total                     buckets of the key
``counter_diff``   Sensor, Day, daily_diff                buckets of the key
``accepted_daily`` Sensor, Day, Totalw1                   buckets of the key
``rejected``       Sensor, RejectedEvent, RejectedVal     buckets of the key
``leak``           Meter, Day, LeakValue                  buckets of the key
=================  =====================================  ==============

The results are revised as readings arrive (update mode), so their topics
are revision logs, and their datasets hold the last revision of each key
(:data:`KEYS`) as its one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsense import registry
from gridsense.functions.parse import (PAYLOAD_SEP, decode_json, drop_invalid, keep_valid,
                                       parse_reading, payload_field, sensor_from_topic,
                                       strict_double)
from gridsense.operators.counter import SINGLE_DROP, SINGLE_VALUE, counter_daily_diff
from gridsense.operators.late import split_late
from gridsense.operators.leak import leak, leak_of_revisions
from gridsense.operators.rollup import daily_rollup, plausible, rejected_rollup
from gridsense.sources import keyed_store
from gridsense.sources.io import append_clustered, append_dataset, read_dataset
from gridsense.streaming import keyed
from gridsense.streaming.retention import compact
from gridsense.streaming.sinks import REVISION, start_topic_sink, stream_revisions

PERIOD_PARTITION = "month"  # first day of the UTC month, a DATE

# Record schemas of the two topics the leak job reads.
SUB_SCHEMA = "Day TIMESTAMP, Totalw1 DOUBLE"
TOTAL_SCHEMA = "Day TIMESTAMP, daily_diff DOUBLE"


def sensor_readings(messages: DataFrame, sensors=None, numeric: bool = True,
                    valid_only: bool = True, topics=None) -> DataFrame:
    """Messages -> ``(Sensor, DateTime, NumVal | Val)`` for the given sensor
    names (all when None).

    ``topics`` subscribes to these topics: unlike the names, which are a
    function of the topic, this filter reaches the scan. ``valid_only`` drops
    rows whose time or value did not parse; it is done with
    :func:`~gridsense.functions.parse.keep_valid`, so every message is parsed
    once (a plain filter on parsed columns would be pushed below the parsing
    and parse it twice, ~2x the cost on the hot path).
    """
    if topics is not None:
        messages = messages.where(F.col("topic").isin(list(topics)))
    m = messages.select(sensor_from_topic("topic").alias("Sensor"), "payload")
    if sensors is not None and topics is None:
        m = m.where(F.col("Sensor").isin(list(sensors)))
    r = parse_reading(m, keep=["Sensor"], numeric=numeric)
    if valid_only:
        r = drop_invalid(r, ("DateTime", "NumVal" if numeric else "Val"))
    return r


def subscribed(messages: DataFrame, names, sensors=registry.HOUSEHOLD, numeric: bool = True) -> DataFrame:
    """Readings of the named sensors by their topics in the registry; names
    it does not list are taken from any topic that ends with them."""
    topic_of = {x.name: x.topic for x in sensors}
    known = all(n in topic_of for n in names)
    return sensor_readings(messages, list(names), numeric,
                           topics=[topic_of[n] for n in names] if known else None)


def gauge_daily(readings: DataFrame, sensors=registry.HOUSEHOLD, delay: str | None = None,
                round_to: int | None = 2, watermark_each=None) -> DataFrame:
    """``(Sensor, Day, Total)``: each gauge's daily sum or average, as the
    registry says (a sensor it does not list is summed), from one keyed
    aggregate over all sensors (``watermark_each``: sensors watermarked one
    by one in a stream)."""
    both = daily_rollup(readings, how=["sum", "avg"], by="Sensor", delay=delay,
                        round_to=round_to, out=["_sum", "_avg"], watermark_each=watermark_each)
    total = F.when(registry.how_of(F.col("Sensor"), sensors) == "avg", F.col("_avg")) \
        .otherwise(F.col("_sum"))
    return both.select("Sensor", "Day", total.alias("Total"))


def as_reference_record(df: DataFrame, sensor: str, value: str = "Total") -> DataFrame:
    """One sensor's rows as ``(Day, Total<Sensor>)``, the reference's record."""
    return df.where(F.col("Sensor") == sensor).select("Day", F.col(value).alias(f"Total{sensor}"))


# -- raw path ---------------------------------------------------------------

def ingest_raw(messages: DataFrame, sensors=registry.HOUSEHOLD, with_rejects: bool = False):
    """Raw messages -> typed envelopes ``(Sensor, DateTime, value, domain)``.

    Rows whose value is not a plain number are dropped in every domain (the
    reference drops them for water only and fails on them elsewhere). The
    device's time text becomes a TIMESTAMP, as the store's time-field
    conversion does. ``with_rejects=True`` returns ``(envelopes, rejects)``:
    the dropped messages as ``(topic, payload, reason)``, to count or to keep
    in a dead-letter folder; both are filters of the same input.
    """
    sensor = sensor_from_topic("topic")
    dom = F.coalesce(registry.domain_of(sensor, sensors),
                     F.element_at(F.split(F.col("topic"), "/"), 2))
    fields = messages.select(sensor.alias("Sensor"),
                             F.try_to_timestamp(payload_field("payload", 0)).alias("DateTime"),
                             payload_field("payload", 1).alias("value"), dom.alias("domain"))
    typed = fields.select("Sensor", "DateTime", strict_double("value").alias("value"), "domain")
    env = keep_valid(typed, ["DateTime", "value"])
    if not with_rejects:
        return env
    ts_text, val_text = payload_field("payload", 0), payload_field("payload", 1)
    reason = (F.when(F.col("payload").isNull() | ~F.col("payload").contains(PAYLOAD_SEP),
                     F.lit("no separator"))
              .when(F.try_to_timestamp(ts_text).isNull(), F.lit("bad time"))
              .when(strict_double(val_text).isNull(), F.lit("bad value")))
    rejects = messages.select("topic", "payload", reason.alias("reason")) \
        .where(F.col("reason").isNotNull())
    return env, rejects


# Fields of the raw envelope.
ENVELOPE_SCHEMA = "Sensor STRING, DateTime STRING, value DOUBLE"


def envelope_readings(records: DataFrame) -> DataFrame:
    """Raw-envelope topic records (JSON ``{Sensor, DateTime, value}`` in a
    ``value`` column) -> readings ``(Sensor, DateTime, NumVal)`` for the
    roll-ups, so consumers can read the raw topics instead of the devices."""
    env = decode_json(records, ENVELOPE_SCHEMA)
    return env.select("Sensor", F.try_to_timestamp("DateTime").alias("DateTime"),
                      F.col("value").alias("NumVal")).where(
        F.col("DateTime").isNotNull() & F.col("NumVal").isNotNull())


def store_raw(envelopes: DataFrame, path: str, mode: str = "append", by_month: bool = True,
              clustered: bool = False) -> str:
    """``clustered``: partitioned by month only, clustered by sensor and time
    (:func:`~gridsense.sources.io.append_clustered`), for thousands of sensors.

    Append envelopes to the raw dataset, partitioned by domain, sensor and
    (``by_month``) UTC month, so that a time-range read over a long history
    opens only the month folders it needs; inside them, files sorted by time
    let row-group statistics skip the rest."""
    if clustered:
        rows = envelopes.withColumn(PERIOD_PARTITION, F.trunc(F.to_date("DateTime"), "month"))
        return append_clustered(rows, path, (PERIOD_PARTITION,), mode=mode)
    parts = ("domain", "Sensor")
    if by_month:
        envelopes = envelopes.withColumn(PERIOD_PARTITION, F.trunc(F.to_date("DateTime"), "month"))
        parts = (*parts, PERIOD_PARTITION)
    return append_dataset(envelopes, path, partition_by=parts, sort_within=("DateTime",), mode=mode)


def store_daily(daily: DataFrame, path: str, mode: str = "append") -> str:
    """Append ``(Sensor, Day, Total)`` roll-ups to a dataset partitioned by
    month (one row per sensor and day: few rows, so no folder per sensor) and
    sorted by sensor."""
    rows = daily.withColumn(PERIOD_PARTITION, F.trunc(F.to_date("Day"), "month"))
    return append_dataset(rows, path, partition_by=(PERIOD_PARTITION,), sort_within=("Sensor", "Day"), mode=mode)


# -- domain jobs ------------------------------------------------------------

def energy_job(messages: DataFrame, counter_lt: float | None, sensors=registry.HOUSEHOLD,
               delay: str | None = None, counter_delay: str | None = None,
               watermark_per_sensor: bool = False) -> dict[str, DataFrame]:
    """Daily sums of the energy gauges; daily difference of the energy counter.

    As in the reference the counter difference is unrounded, labelled by a
    DATE, and a window with a single reading reports that reading, hidden
    by ``counter_lt`` when it is the total so far; pass ``counter_lt=None``
    to keep pairs only instead. ``watermark_per_sensor`` gives each gauge its
    own watermark, as the reference's one query per topic has.
    """
    gauges = registry.names(sensors, domain="energy", kind="gauge")
    counters = registry.names(sensors, domain="energy", kind="counter")
    daily = gauge_daily(subscribed(messages, gauges, sensors), sensors, delay=delay,
                        watermark_each=gauges if watermark_per_sensor else None)
    single = SINGLE_DROP if counter_lt is None else SINGLE_VALUE
    diff = counter_daily_diff(subscribed(messages, counters, sensors), by="Sensor",
                              delay=counter_delay, single=single, round_to=None, day_type="date")
    if counter_lt is not None:
        diff = plausible(diff, "daily_diff", lt=counter_lt)
    return {"daily": daily, "counter_diff": diff}


def temp_job(messages: DataFrame, sensors=registry.HOUSEHOLD, delay: str | None = None,
             watermark_per_sensor: bool = False) -> dict[str, DataFrame]:
    """Daily averages of the temperature gauges and the daily movement count."""
    names = registry.names(sensors, domain="temp")
    return {"daily": gauge_daily(subscribed(messages, names, sensors), sensors,
                                 delay=delay,
                                 watermark_each=names if watermark_per_sensor else None)}


def water_job(messages: DataFrame, sub_gt: float | None, counter_lt: float | None = None,
              sub_meters=("W1",), counters=("Wtot",), accept_delay: str | None = None,
              counter_delay: str | None = None,
              rejected_delay: str | None = None, sensors=registry.HOUSEHOLD) -> dict[str, DataFrame]:
    """Water: accepted daily sums of the sub-meters (late rows routed away),
    their rejected-late 10-minute sums, and the counter's daily difference.

    ``sub_gt`` hides partial days (the reference's ``> 40``, needed when the
    sums go out in update mode); ``counter_lt`` keeps the reference's
    single-reading rule with its bound, else pairs only are kept.
    """
    flagged = subscribed(messages, sub_meters, sensors, numeric=False)
    accepted, rejected = split_late(flagged)
    accepted_daily = daily_rollup(accepted, by="Sensor", delay=accept_delay, out="Totalw1")
    if sub_gt is not None:
        accepted_daily = plausible(accepted_daily, "Totalw1", gt=sub_gt)
    single = SINGLE_DROP if counter_lt is None else SINGLE_VALUE
    diff = counter_daily_diff(subscribed(messages, counters, sensors), by="Sensor",
                              delay=counter_delay, single=single)
    if counter_lt is not None:
        diff = plausible(diff, "daily_diff", lt=counter_lt)
    rej = rejected_rollup(rejected, by="Sensor", delay=rejected_delay)
    return {"accepted_daily": accepted_daily, "counter_diff": diff, "rejected": rej}


def leak_job(sub_records: DataFrame, total_records: DataFrame, watermark: str | None = None,
             revision: str | None = None) -> DataFrame:
    """``(Day, LeakValue)`` from the decoded sub-meter and counter records.

    In a stream both inputs are append-mode topics and ``watermark`` bounds
    the join state; in batch ``revision`` resolves update-mode revisions
    first, so each day gives one leak row.
    """
    return leak(sub_records, total_records, watermark=watermark, revision=revision)


# -- the whole application as streaming queries ------------------------------

# The sub-meter whose leak against its meter the reference
# computes (W1 against Wtot).
LEAK_PAIRS = (("W1", "Wtot"),)
LEAK_TOPICS = ("accepted_daily", "counter_diff")
DAILY_SCHEMA = "Sensor STRING, Day TIMESTAMP, Total DOUBLE"
ACCEPTED_SCHEMA = "Sensor STRING, Day TIMESTAMP, Totalw1 DOUBLE"
COUNTER_SCHEMA = "Sensor STRING, Day TIMESTAMP, daily_diff DOUBLE"


def start_household(messages: DataFrame, root: str, sensors=registry.HOUSEHOLD,
                    late_sensors=None, gauge_delay: str | None = None,
                    accept_delay: str | None = "3 days", counter_delay: str | None = None,
                    rejected_delay: str | None = None, sub_gt: float | None = None,
                    trigger: dict | None = None, name_prefix: str = "", raw: bool = True,
                    kafka: dict[str, str] | None = None, compact_every: int | None = None,
                    store_root: str | None = None, counter_days: int | None = None) -> list:
    """Start stage one of the application over one message stream: streaming
    queries, each one keyed aggregate over all its sensors, writing JSON topic
    folders under ``root`` (or, with ``kafka`` connector options, Kafka topics
    of the same names; ``root`` then holds the checkpoints):

    * ``daily``: every gauge's daily sum or average (all domains at once);
    * ``counter_diff``: every counter's daily difference (pairs only);
    * ``accepted_daily`` / ``rejected``: the late-routed sub-meters
      (``late_sensors``, default the water gauges);
    * ``raw`` (unless off): every reading as an envelope, one folder per domain.

    All but the raw readings run in update mode: a result leaves as soon as
    its first reading is there and again whenever it is revised, so nothing
    waits for a watermark. A watermark only bounds the state. Gauges, counters
    and rejected readings have none (their state is one row per sensor and day
    or ten minutes); the sub-meters have the reference's 3 days. Where a delay
    of gauges or sub-meters is given, each sensor has its own watermark, as in
    the reference, so that sensors out of step lose nothing. ``compact_every``:
    after each so many batches a result topic is compacted, and batch folders go
    that the leak query and, with ``store_root``, the store have read.
    ``counter_days``: counters hold the first readings of so many days each as
    state, not every window (:func:`~gridsense.streaming.keyed.keyed_counter_diff`).
    Returns the started queries.
    """
    late = list(late_sensors) if late_sensors is not None else \
        registry.names(sensors, domain="water", kind="gauge")
    gauges = [x.name for x in sensors if x.kind in ("gauge", "flag") and x.name not in late]
    counters = registry.names(sensors, kind="counter")
    accepted, rejected = split_late(subscribed(messages, late, sensors, numeric=False))
    accepted_daily = daily_rollup(accepted, by="Sensor", delay=accept_delay, out="Totalw1",
                                  watermark_each=late if len(late) > 1 else None)
    if sub_gt is not None:
        accepted_daily = plausible(accepted_daily, "Totalw1", gt=sub_gt)
    outs = {
        "daily": gauge_daily(subscribed(messages, gauges, sensors), sensors, delay=gauge_delay,
                             watermark_each=gauges if len(gauges) > 1 else None),
        "counter_diff": counter_daily_diff(subscribed(messages, counters, sensors), by="Sensor", delay=counter_delay)
        if counter_days is None else
        keyed.keyed_counter_diff(subscribed(messages, counters, sensors), counter_days),
        "accepted_daily": accepted_daily,
        "rejected": rejected_rollup(rejected, by="Sensor", delay=rejected_delay),
    }
    kw = dict(fmt="kafka" if kafka else "json", trigger=trigger)

    def compaction(name: str):
        if compact_every is None or kafka:
            return None
        readers = [f"{root}/leak.checkpoint"] if name in LEAK_TOPICS else []
        readers += [f"{store_root}/{name}.checkpoint"] if store_root else []
        return compact_every, lambda spark: compact(spark, f"{root}/{name}", KEYS[name], readers,
                                                    json_schema=TOPIC_SCHEMAS[name])

    def start(name: str, df: DataFrame):
        return start_topic_sink(df, f"{root}/{name}", mode="update", query_name=f"{name_prefix}{name}",
                                options={**kafka, "topic": name} if kafka else None, compact=compaction(name), **kw)

    started = []
    for name, df in outs.items():
        if name == "counter_diff" and counter_days is not None:
            with keyed.rocksdb(messages.sparkSession):
                started.append(start(name, df))
        else:
            started.append(start(name, df))
    if raw:
        env = ingest_raw(messages, sensors)
        started.append(start_topic_sink(env, f"{root}/raw", query_name=f"{name_prefix}raw",
                                        partition_by=None if kafka else ["domain"],
                                        options={**kafka, "topic": "raw"} if kafka else None, **kw))
    return started


def _open_revisions(spark: SparkSession, root: str, name: str, kafka: dict[str, str] | None) -> DataFrame:
    """A result topic as a stream of revisions ``(record, batch_id)``."""
    schema = TOPIC_SCHEMAS[name]
    if kafka:
        raw = spark.readStream.options(**kafka, subscribe=name).format("kafka").load()
        return decode_json(raw.withColumn(REVISION, F.unix_micros("timestamp")), schema, keep=[REVISION])
    # The folder must be there before it is watched; an empty batch is none.
    spark.range(0).select(F.col("id").cast("string").alias("value")) \
        .write.mode("overwrite").text(f"{root}/{name}/{REVISION}=-1")
    return stream_revisions(spark, f"{root}/{name}", schema)


def start_leak(spark: SparkSession, root: str, pairs=LEAK_PAIRS, trigger: dict | None = None,
               name_prefix: str = "", kafka: dict[str, str] | None = None):
    """Start stage two: the leak of each sub-meter against its meter from the
    ``accepted_daily`` and ``counter_diff`` topics under ``root`` (or Kafka
    topics, with ``kafka`` connector options), into the ``leak`` topic as
    ``(Meter, Day, LeakValue)`` records, revised whenever a side is."""
    meter_of = registry.map_literal(pairs)
    sub = _open_revisions(spark, root, "accepted_daily", kafka)
    sub = sub.where(F.col("Sensor").isin([a for a, _ in pairs])) \
        .select(F.element_at(meter_of, F.col("Sensor")).alias("Meter"), "Day", "Totalw1", REVISION)
    total = _open_revisions(spark, root, "counter_diff", kafka)
    total = total.where(F.col("Sensor").isin([b for _, b in pairs])) \
        .select(F.col("Sensor").alias("Meter"), "Day", "daily_diff", REVISION)
    found = leak_of_revisions(sub, total, REVISION, by="Meter")
    return start_topic_sink(found, f"{root}/leak", mode="update", fmt="kafka" if kafka else "json",
                            trigger=trigger, query_name=f"{name_prefix}leak",
                            options={**kafka, "topic": "leak"} if kafka else None)


# -- the store ------------------------------------------------------------------

RESULTS = ("daily", "counter_diff", "accepted_daily", "rejected", "leak")
# Rows of a raw partition are dealt over so many tasks of a micro-batch, so
# that a sensor with much of the data is not written by one.
RAW_SPREAD = 8


def start_store(spark: SparkSession, topics_root: str, store_root: str, names=RESULTS,
                trigger: dict | None = None, name_prefix: str = "store_") -> list:
    """Keep result topics as typed datasets of one row per key
    (:mod:`~gridsense.sources.keyed_store`), one streaming query per topic with a
    checkpoint of its own: a topic's record is stored once however often the
    store is run. Read with :func:`read_store`."""
    def start(name: str):
        path = f"{store_root}/{name}"

        def write(batch: DataFrame, batch_id: int) -> None:
            keyed_store.merge(batch, path, KEYS[name], REVISION, batch_id, KEYS[name][-1])

        w = _open_revisions(spark, topics_root, name, None).writeStream.foreachBatch(write) \
            .option("checkpointLocation", f"{path}.checkpoint").queryName(f"{name_prefix}{name}")
        return (w.trigger(**trigger) if trigger else w).start()

    return [start(name) for name in names]


def start_raw_store(messages: DataFrame, store_root: str, sensors=registry.HOUSEHOLD,
                    trigger: dict | None = None, name_prefix: str = "store_"):
    """Keep every reading of the message stream in the ``raw`` dataset."""
    env = ingest_raw(messages, sensors).withColumn(PERIOD_PARTITION, F.trunc(F.to_date("DateTime"), "month"))
    spread = F.pmod(F.xxhash64("DateTime"), F.lit(RAW_SPREAD))
    dealt = env.repartition(*LAYOUT["raw"], spread)
    return start_topic_sink(dealt, f"{store_root}/raw", fmt="parquet", partition_by=LAYOUT["raw"],
                            trigger=trigger, query_name=f"{name_prefix}raw")


def read_store(spark: SparkSession, store_root: str, name: str) -> DataFrame:
    """The rows of a result dataset, one per key."""
    return keyed_store.read_keyed(spark, f"{store_root}/{name}", schema=TOPIC_SCHEMAS[name]).drop(REVISION)


# -- dashboard panels ---------------------------------------------------------

# The dashboard's six panels: dataset, sensor filter, time column.
PANELS = {
    "th2_daily_avg": ("daily", "TH2", "Day"),
    "th1_raw": ("raw", "TH1", "DateTime"),
    "late_rejected": ("rejected", None, "RejectedEvent"),
    "w1_raw": ("raw", "W1", "DateTime"),
    "etot_diff": ("counter_diff", "Etot", "Day"),
    "water_leak": ("leak", None, "Day"),
}
# Partition columns of the raw dataset.
LAYOUT = {"raw": ("domain", "Sensor", PERIOD_PARTITION)}
# Key columns of the result datasets.
KEYS = {
    "daily": ("Sensor", "Day"),
    "counter_diff": ("Sensor", "Day"),
    "accepted_daily": ("Sensor", "Day"),
    "rejected": ("Sensor", "RejectedEvent"),
    "leak": ("Meter", "Day"),
}
# Record schemas of the topics.
TOPIC_SCHEMAS = {
    "daily": DAILY_SCHEMA,
    "counter_diff": COUNTER_SCHEMA,
    "accepted_daily": ACCEPTED_SCHEMA,
    "rejected": "Sensor STRING, RejectedEvent TIMESTAMP, RejectedVal DOUBLE",
    "leak": "Meter STRING, Day TIMESTAMP, LeakValue DOUBLE",
}


def panel(spark: SparkSession, root: str, name: str, start=None, end=None,
          panels: dict = PANELS, sensor: str | None = None) -> DataFrame:
    """One panel's rows: a stored dataset, filtered by sensor and by the
    dashboard's time range (both pushed to the scan). A result dataset that the
    store keeps by key is read from the buckets of its sensor and range."""
    dataset, default_sensor, ts = panels[name]
    sensor, sensor_col = sensor or default_sensor, "Meter" if dataset == "leak" else "Sensor"
    if dataset != "raw" and keyed_store.exists(spark, f"{root}/{dataset}"):
        return keyed_store.read_keyed(spark, f"{root}/{dataset}", sensor, start, end, at=ts,
                                      entity_col=sensor_col, schema=TOPIC_SCHEMAS[dataset]).drop(REVISION)
    return read_dataset(spark, f"{root}/{dataset}", sensor=sensor, start=start, end=end, ts=ts,
                        sensor_col=sensor_col)
