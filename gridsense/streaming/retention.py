"""Retention of update-mode topics (K2, K9).

An update-mode sink writes a folder per micro-batch. :func:`compact` writes the
current rows as a snapshot and then removes the folders that the snapshot covers
and that every reader of the topic has read: a reader is a streaming query, and
its checkpoint tells which files it has committed. So the number of files stays
bounded while the stream runs, a reader that is restarted finds all it has not
read, and batch readers get the same rows as before (:func:`read_revisions`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridsense.streaming.marks import list_folders, list_names, noted, remove
from gridsense.streaming.sinks import REVISION, snapshot_revisions


def consumed_files(spark: SparkSession, path: str, checkpoint: str, batches, revision: str = REVISION) -> set[str]:
    """``<batch>/<file>`` of the files of these batch folders of the topic
    ``path`` that the streaming query with this checkpoint has committed."""
    commits = list_folders(spark, f"{checkpoint}/commits", "")
    found: set[str] = set()
    for source in list_names(spark, f"{checkpoint}/sources") if commits else ():
        log = f"{checkpoint}/sources/{source}"
        if not any(x.split(".")[0].isdigit() for x in list_names(spark, log)):
            continue
        # Lines of JSON after a version line; one per file of the topic.
        lines = spark.read.text(log).select(F.from_json("value", "path STRING, batchId LONG").alias("f")).select("f.*")
        parts = rf"/{path.rstrip('/').rsplit('/', 1)[-1]}/{revision}=(\d+)/([^/]+)$"
        batch, name = (F.regexp_extract("path", parts, k) for k in (1, 2))
        own = lines.where((F.col("batchId") <= commits[-1]) & batch.isin([str(b) for b in batches]))
        found |= {r[0] for r in own.select(F.concat_ws("/", batch, name)).distinct().collect()}  # of folders still there
    return found


def compact(spark: SparkSession, path: str, keys: Sequence[str], readers: Sequence[str] = (),
            revision: str = REVISION, json_schema: str | None = None) -> int:
    """Snapshot the topic and remove what is covered and read; ``readers``:
    checkpoints of the streaming queries that read it (one that has not started
    yet keeps every folder). Returns the number of folders removed. Call it from
    the writer's side or between its batches; safe while readers run."""
    path = path.rstrip("/")
    upto = snapshot_revisions(spark, path, keys, revision, json_schema)
    if upto is None:
        return 0
    gone = {b for b in list_folders(spark, path, f"{revision}=") if 0 <= b <= upto}
    for checkpoint in readers:
        read = consumed_files(spark, path, checkpoint, gone, revision)
        gone = {b for b in gone if all(f"{b}/{f}" in read for f in list_names(spark, f"{path}/{revision}={b}")
                                       if not f.startswith(("_", ".")))}
    for b in sorted(gone):
        remove(spark, f"{path}/{revision}={b}")
    latest = noted(spark, f"{path}_snapshots/latest")
    old = [n for n in list_folders(spark, f"{path}_snapshots", "upto=") if n < latest]
    for n in old[:-1]:  # the one before may still be read
        remove(spark, f"{path}_snapshots/upto={n}")
    return len(gone)
