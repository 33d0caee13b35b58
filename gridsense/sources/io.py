"""Sources and sinks: message streams, JSON topics, stored datasets.

Brokers of the reference (an MQTT broker, Kafka, a document store) are
stand-ins for storage with an append log; here they are folders:

* a *message* folder holds ``(topic, payload)`` rows (Parquet or JSON), or
  plain text lines of one topic;
* a *topic* folder holds one JSON record per line (``to_json`` output);
* a *dataset* is Parquet, partitioned by sensor (raw readings also by
  domain and month), read back with partition pruning and pushed-down
  time-range filters.

``fmt="kafka"`` (or any other streaming connector) passes options through
when its jar is on the class path.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridsense.functions.parse import decode_json, encode_json

MESSAGE_SCHEMA = "topic STRING, payload STRING"
DEALT = "_dealt"  # the part of a partition that a row is dealt to, not stored


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def read_messages(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                  stream: bool = False, topic: str | None = None,
                  options: dict[str, str] | None = None,
                  max_files_per_trigger: int | None = None,
                  schema: str = MESSAGE_SCHEMA) -> DataFrame:
    """A (streaming) DataFrame ``(topic, payload)`` of raw device messages.

    * ``parquet`` / ``json``: rows with both columns;
    * ``text``: one payload per line; ``topic`` names the single topic;
    * ``kafka``: ``options`` go to the connector; ``value`` becomes the
      payload text.
    """
    opts = dict(options or {})
    if max_files_per_trigger is not None:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    r = _reader(spark, stream).options(**opts)
    if fmt == "kafka":
        df = r.format("kafka").load()
        return df.select(F.col("topic"), F.col("value").cast("string").alias("payload"))
    if fmt == "text":
        df = r.format("text").load(path)
        return df.select(F.lit(topic).cast("string").alias("topic"), F.col("value").alias("payload"))
    if fmt in ("parquet", "json"):
        return r.format(fmt).schema(schema).load(path)
    df = r.format(fmt).load(path) if path else r.format(fmt).load()
    return df


def write_messages(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> str:
    """Store ``(topic, payload)`` messages (the input of a message stream)."""
    df.select("topic", "payload").write.mode(mode).format(fmt).save(path)
    return path


def read_topic(spark: SparkSession, path: str | None, schema: StructType | str,
               stream: bool = False, fmt: str = "text", keep: Iterable[str] = (),
               options: dict[str, str] | None = None) -> DataFrame:
    """Records of a JSON topic, decoded with a fixed schema."""
    r = _reader(spark, stream).options(**(options or {}))
    if fmt == "kafka":
        raw = r.format("kafka").load()
    else:
        raw = r.format(fmt).load(path)
    return decode_json(raw, schema, value="value", keep=keep)


def write_topic(df: DataFrame, path: str, cols: Sequence[str] | None = None,
                mode: str = "append") -> str:
    """Batch write of records as JSON lines (a topic folder)."""
    encode_json(df, cols).write.mode(mode).text(path)
    return path


def append_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ("Sensor",),
                   sort_within: Sequence[str] | None = None, mode: str = "append",
                   fmt: str = "parquet", spread: int = 8) -> str:
    """Keep a DataFrame as a Parquet dataset (a collection of the store).

    Rows are first rebalanced by the partition columns, so a partition is
    written by few tasks (Spark splits the large ones) instead of by every
    task of the scan, and sorted within each task, so that Parquet row-group
    statistics make time-range filters selective on read.

    Spark splits by compressed bytes, which millions of steady readings hardly
    have: so a partition is also dealt, by its ``sort_within`` columns, over
    ``spread`` parts, of which Spark puts small ones together again.
    """
    w = df
    if partition_by and sort_within:
        part = F.pmod(F.xxhash64(*sort_within), F.lit(spread))
        w = w.withColumn(DEALT, part).hint("rebalance", *[F.col(c) for c in (*partition_by, DEALT)]).drop(DEALT)
    elif partition_by:
        w = w.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_within:
        w = w.sortWithinPartitions(*partition_by, *sort_within)
    writer = w.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def append_clustered(df: DataFrame, path: str, partition_by: Sequence[str] = (), entity: str = "Sensor",
                     ts: str = "DateTime", row_group_bytes: int = 8 << 20, entities: int = 100_000,
                     mode: str = "append") -> str:
    """Keep a DataFrame as a dataset for very many sensors: no folder per sensor,
    but rows dealt and sorted by ``entity`` and time (a sensor with much of the
    data is spread by its time), with a Bloom filter of the entity in each row
    group. A read of one sensor and a range opens the row groups and pages whose
    statistics allow it. ``entities``: how many a row group's filter is made for."""
    order = [*partition_by, entity, ts]
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode) \
        .option(f"parquet.bloom.filter.enabled#{entity}", "true") \
        .option(f"parquet.bloom.filter.expected.ndv#{entity}", str(entities)) \
        .option("parquet.bloom.filter.adaptive.enabled", "true") \
        .option("parquet.block.size", str(row_group_bytes)) \
        .option("parquet.page.row.count.limit", "5000")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_dataset(spark: SparkSession, path: str, sensor: str | Sequence[str] | None = None,
                 start=None, end=None, ts: str = "DateTime", sensor_col: str = "Sensor",
                 fmt: str = "parquet", schema: StructType | str | None = None,
                 month_col: str = "month") -> DataFrame:
    """Scan a stored dataset, optionally for some sensors and a time range.

    The sensor filter prunes partition folders; the range (both ends
    inclusive, as a dashboard range) is pushed to the Parquet scan and, when
    the dataset is partitioned by month (``month_col``, first day of the
    month), prunes month folders too.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    if schema is None:
        # Folder names like "007" would be read as numbers: names are text.
        names = {sensor_col, "domain"}
        if any(f.name in names and f.dataType != StringType() for f in df.schema):
            df = r.schema(StructType([StructField(f.name, StringType()) if f.name in names else f
                                      for f in df.schema])).load(path)
    if sensor is not None:
        sensors = [sensor] if isinstance(sensor, str) else list(sensor)
        df = df.where(F.col(sensor_col).isin(sensors))
    by_month = month_col in df.columns
    if start is not None:
        lo = F.lit(start).cast("timestamp")
        df = df.where(F.col(ts) >= lo)
        if by_month:
            df = df.where(F.col(month_col) >= F.trunc(F.to_date(lo), "month"))
    if end is not None:
        hi = F.lit(end).cast("timestamp")
        df = df.where(F.col(ts) <= hi)
        if by_month:
            df = df.where(F.col(month_col) <= F.trunc(F.to_date(hi), "month"))
    return df
