"""Datasets that hold one row per key, for results that are revised (K5).

Keys are dealt to a fixed number of buckets by hash, here by sensor and month, so
that a sensor with much of the history is spread and a panel's read of one sensor
and a few months opens a few buckets. A merge reads the buckets that its rows
touch, keeps the latest row of each key, writes these buckets as a new version
and then switches: a manifest names the version of every bucket, and a mark names
the manifest. Readers see one manifest throughout. A merge that is repeated after
its switch does nothing; one that failed before it is written over.

Folders: ``<path>/v=<version>/bucket=<n>`` and ``<path>_manifests``. Versions of
a bucket that neither the new manifest nor the one before names are removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridsense.operators.leak import latest_per_key
from gridsense.streaming.marks import list_folders, note, noted, remove

BUCKETS = 64


def _month(c) -> Column:
    return F.trunc(F.to_date(c), "month")


def _bucket(entity: Column, at: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(entity, _month(at)), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, path: str) -> dict[int, int] | None:
    """Version of each bucket that has rows, or None where nothing was merged."""
    n = noted(spark, f"{path}_manifests/latest")
    if n is None:
        return None
    rows = spark.read.parquet(f"{path}_manifests/n={n}").collect()  # a row per bucket at most
    return {r["bucket"]: r["version"] for r in rows}


def _read(spark: SparkSession, path: str, manifest: dict[int, int], schema=None) -> DataFrame:
    files = [f"{path}/v={v}/bucket={b}" for b, v in sorted(manifest.items())]
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(*files)


def merge(batch: DataFrame, path: str, keys: Sequence[str], order: str, version: int, at: str,
          buckets: int = BUCKETS) -> None:
    """Merge ``batch`` into the dataset: of each key (``keys``, the first names
    the entity) the row of greatest ``order`` stays. ``at``: the key's time
    column. ``version``: a number that grows with each merge, as a stream's
    batch ids do. The number of buckets is fixed at the first merge."""
    spark, path = batch.sparkSession, path.rstrip("/")
    done = noted(spark, f"{path}_manifests/latest")
    if done is not None and version <= done:
        return
    now = _manifest(spark, path) or {}
    batch = batch.withColumn("bucket", _bucket(F.col(keys[0]), F.col(at), buckets))
    new = latest_per_key(batch, [*keys, "bucket"], order, keep_order=True).persist()
    given = new
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
    if touched:
        held = {b: now[b] for b in touched if b in now}
        if held:
            old = _read(spark, path, held, new.drop("bucket").schema)
            old = old.withColumn("bucket", _bucket(F.col(keys[0]), F.col(at), buckets))
            new = latest_per_key(old.unionByName(new), [*keys, "bucket"], order, keep_order=True)
        new.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", keys[0], at) \
            .write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/v={version}")
    given.unpersist()
    rows = sorted({**now, **{b: version for b in touched}}.items())
    spark.createDataFrame(rows, "bucket INT, version LONG").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}_manifests/n={version}")
    note(spark, f"{path}_manifests/latest", version)
    _clean(spark, path, dict(rows), now, version, done)


def _clean(spark: SparkSession, path: str, new: dict, before: dict, version: int, done: int | None) -> None:
    """Remove what neither of the last two manifests names."""
    named = {(v, b) for m in (new, before) for b, v in m.items()}
    for v in list_folders(spark, path, "v="):
        held = [b for n, b in named if n == v]
        if v <= version and not held:
            remove(spark, f"{path}/v={v}")
        elif v <= version:
            for b in list_folders(spark, f"{path}/v={v}", "bucket="):
                if b not in held:
                    remove(spark, f"{path}/v={v}/bucket={b}")
    for n in list_folders(spark, f"{path}_manifests", "n="):
        if n not in (version, done):
            remove(spark, f"{path}_manifests/n={n}")


def exists(spark: SparkSession, path: str) -> bool:
    return noted(spark, f"{path.rstrip('/')}_manifests/latest") is not None


def read_keyed(spark: SparkSession, path: str, entity: str | None = None, start=None, end=None, at: str = "Day",
               entity_col: str = "Sensor", buckets: int = BUCKETS, schema: str | None = None) -> DataFrame:
    """The current rows, one per key. With an entity and both ends of a time
    range only the buckets of its months are opened; each filter is pushed to
    the scan. ``schema``: the columns of a dataset that may have no rows yet."""
    path = path.rstrip("/")
    manifest = _manifest(spark, path)
    if not manifest:
        if schema is None:
            raise FileNotFoundError(f"no rows under {path}")
        return spark.createDataFrame([], schema)
    if entity is not None and start is not None and end is not None:
        first, last = (F.lit(x).cast("timestamp") for x in (start, end))
        months = spark.range(1).select(F.explode(F.sequence(
            _month(first), _month(last), F.expr("INTERVAL 1 MONTH"))).alias("m"))
        wanted = {r["b"] for r in months.select(_bucket(F.lit(entity), F.col("m"), buckets).alias("b")).collect()}
        # A file of any bucket gives the schema where none of them has rows.
        opened = {b: v for b, v in manifest.items() if b in wanted} or dict([next(iter(manifest.items()))])
    else:
        opened = manifest
    df = _read(spark, path, opened)
    if entity is not None:
        df = df.where(F.col(entity_col) == entity)
    if start is not None:
        df = df.where(F.col(at) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(at) <= F.lit(end).cast("timestamp"))
    return df
