"""Streaming sinks and runners.

* append mode writes through Spark's file sink (Parquet, or JSON lines for a
  topic folder), exactly once via its ``_spark_metadata`` log;
* update / complete mode goes through ``foreachBatch`` into a *revision log*:
  each micro-batch is a folder ``<path>/<revision>=<batch id>`` (Parquet, or
  JSON lines whose records carry the batch id). A batch counts once it is
  noted in ``<path>_commits`` and is then never written again, so a batch that
  is replayed after a failure replaces its own unfinished output, and readers
  see whole batches only. Readers resolve revisions with
  :func:`read_revisions` (the last revision per key;
  :func:`snapshot_revisions` bounds what they scan).

Each query has its own checkpoint folder, under the shared work folder by
default (``spark.checkpoint.dir``), so a restarted driver resumes from the
last committed batch. The number of state-store partitions of a query is the
session's ``spark.sql.shuffle.partitions`` at its first start.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridsense.functions.parse import decode_json, encode_json
from gridsense.streaming.marks import list_folders, note, noted

REVISION = "batch_id"


def _revision_writer(path: str, fmt: str, revision: str, json_cols: Sequence[str] | None, compact=None):
    path = path.rstrip("/")
    written = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal written
        spark = batch.sparkSession
        done = noted(spark, f"{path}_commits")
        if done is not None and batch_id <= done:
            return  # replayed after its commit: it is whole already
        out = f"{path}/{revision}={batch_id}"
        if fmt == "json":
            cols = list(json_cols or batch.columns)
            rows = batch.select(*cols, F.lit(batch_id).cast("long").alias(revision))
            encode_json(rows).write.mode("overwrite").text(out)
        else:
            batch.write.mode("overwrite").format(fmt).save(out)
        note(spark, f"{path}_commits", batch_id)
        written += 1
        if compact is not None and written % compact[0] == 0:
            compact[1](spark)
    return write


def start_topic_sink(df: DataFrame, path: str, checkpoint: str | None = None,
                     mode: str = "append", fmt: str = "parquet", query_name: str | None = None,
                     trigger: dict | None = None, partition_by: Sequence[str] | None = None,
                     json_cols: Sequence[str] | None = None, revision: str = REVISION,
                     options: dict[str, str] | None = None, compact=None) -> StreamingQuery:
    """Start a streaming query writing ``df`` to the folder ``path``.

    ``fmt="json"`` stores one JSON record per line in a text folder (a
    topic, readable with :func:`~gridsense.sources.io.read_topic`);
    ``json_cols`` picks and orders the record fields, and ``partition_by``
    columns become sub-folders (e.g. one raw topic per domain). ``trigger``
    is passed to ``DataStreamWriter.trigger`` (e.g. ``{"availableNow": True}``).
    ``fmt="kafka"`` writes the JSON records as the ``value`` of a Kafka
    topic (``options``: ``kafka.bootstrap.servers``, ``topic``; needs the
    connector jar, so it is untested here); ``path`` then only names the
    default checkpoint folder. ``compact``: ``(every, function)``, for update
    mode: after each so many batches ``function(spark)`` is called between two
    of them (see :func:`~gridsense.streaming.retention.compact`).
    """
    checkpoint = checkpoint or path.rstrip("/") + ".checkpoint"
    if fmt == "kafka" or (fmt == "json" and mode == "append"):
        keep = list(partition_by or []) if fmt == "json" else []
        cols = json_cols or [c for c in df.columns if c not in keep]
        df = encode_json(df, cols, keep=keep)
        fmt = "text" if fmt == "json" else fmt
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint) \
        .options(**(options or {}))
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    if fmt == "kafka":
        w = w.format("kafka")
    elif mode == "append":
        w = w.format(fmt).option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
    else:
        w = w.foreachBatch(_revision_writer(path, fmt, revision, json_cols, compact))
    return w.start()


def wait_for(queries: Iterable[StreamingQuery]) -> None:
    """Wait until all queries have ended; stop the others if one fails."""
    queries = list(queries)
    try:
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def run_available(df: DataFrame, path: str, **kw) -> str:
    """Run a streaming query over all data available now, wait for it, and
    return the output folder."""
    wait_for([start_topic_sink(df, path, trigger={"availableNow": True}, **kw)])
    return path


def run_available_together(runs: Iterable[tuple[DataFrame, str, dict]]) -> list[str]:
    """Start several ``(df, path, options)`` streaming queries over the data
    available now, let them run side by side, and wait for all of them."""
    runs = list(runs)
    wait_for([start_topic_sink(df, path, trigger={"availableNow": True}, **kw) for df, path, kw in runs])
    return [path for _, path, _ in runs]


def run_all(queries: Iterable[StreamingQuery], timeout: float | None = None,
            spark: SparkSession | None = None) -> None:
    """Wait until any of the queries ends (or fails), as the reference's jobs
    do; stop the others if one fails."""
    queries = list(queries)
    if not queries:
        return
    spark = spark or SparkSession.getActiveSession()
    try:
        spark.streams.awaitAnyTermination(timeout)
    except Exception:
        for q in queries:
            if q.isActive:
                q.stop()
        raise


# -- revision logs of update-mode sinks ---------------------------------------

def stream_revisions(spark: SparkSession, path: str, schema: str, revision: str = REVISION) -> DataFrame:
    """The records of a JSON revision log as a stream of changes, each with
    its batch id."""
    raw = spark.readStream.option("recursiveFileLookup", True).option("ignoreMissingFiles", True) \
        .schema("value STRING").text(path)
    return decode_json(raw, f"{schema}, {revision} LONG")


def read_revisions(spark: SparkSession, path: str, keys: Sequence[str], revision: str = REVISION,
                   upto: int | None = None, keep_revision: bool = False,
                   json_schema: str | None = None) -> DataFrame:
    """The current rows of an update-mode sink: the newest snapshot (if any)
    plus the committed batch folders after it, resolved to the last revision
    per key (``upto``: as of that batch). Batch folders a snapshot covers are
    pruned by the partition filter, never scanned, and may be gone.
    ``json_schema``: the record's fields, for a log of JSON lines."""
    from gridsense.operators.leak import latest_per_key
    path = path.rstrip("/")
    done = noted(spark, f"{path}_commits")
    last = -1 if done is None else done if upto is None else min(done, upto)
    since = noted(spark, f"{path}_snapshots/latest")
    if since is not None and since > last:
        since = None  # a snapshot beyond ``upto`` does not tell what came before
    snap = None if since is None else spark.read.parquet(f"{path}_snapshots/upto={since}")
    # Only the folders that count are opened.
    lo = -1 if since is None else since
    folders = [f"{path}/{revision}={b}" for b in list_folders(spark, path, f"{revision}=") if lo < b <= last]
    if not folders and snap is None:
        raise FileNotFoundError(f"no committed batch under {path}")
    reader = spark.read.option("basePath", path)
    if not folders:
        batches = snap.limit(0)
    elif json_schema is not None:
        raw = reader.schema(f"value STRING, {revision} LONG").text(folders)
        batches = decode_json(raw.select("value"), f"{json_schema}, {revision} LONG")
    else:
        batches = (reader if snap is None else reader.schema(snap.schema)).parquet(*folders) \
            .withColumn(revision, F.col(revision).cast("long"))
    if snap is not None:
        batches = batches.unionByName(snap.select(*batches.columns))
    return latest_per_key(batches, list(keys), revision, keep_order=keep_revision)


def snapshot_revisions(spark: SparkSession, path: str, keys: Sequence[str],
                       revision: str = REVISION, json_schema: str | None = None) -> int | None:
    """Write the current rows (last revision per key, with its batch id) of
    an update-mode sink as a snapshot covering every committed batch so far;
    returns that batch id.

    Safe while the stream runs: the snapshot has its own folder
    (``<path>_snapshots/upto=<batch id>``, valid once noted in ``latest``), and
    later batches are still read from their own folders. Old batch folders
    may then be removed by the usual retention job; readers no longer touch
    them.
    """
    path = path.rstrip("/")
    upto = noted(spark, f"{path}_commits")
    if upto is None:
        return None
    cur = read_revisions(spark, path, keys, revision, upto=upto, keep_revision=True, json_schema=json_schema)
    cur.write.mode("overwrite").parquet(f"{path}_snapshots/upto={upto}")
    note(spark, f"{path}_snapshots/latest", upto)
    return upto
