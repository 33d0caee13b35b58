"""What streaming queries did, batch by batch, as a dataset (K8).

:class:`ProgressLog` listens to the session's streaming queries and keeps one row
per micro-batch: its number, rows read, rows of state, and what the watermark
dropped (Spark counts that after the partial aggregation: for a windowed
aggregate, windows of a batch that had closed). Rows are appended to a Parquet
folder whenever ``every`` of them have come, and at :meth:`close`.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = ("query STRING, run_id STRING, batch LONG, at TIMESTAMP, input_rows LONG, state_rows LONG, "
          "dropped_by_watermark LONG, seconds DOUBLE")


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of the session's streaming queries under ``path``."""

    def __init__(self, spark: SparkSession, path: str, every: int = 500):
        self.spark, self.path, self.every = spark, path, every
        self._rows: list[tuple] = []
        self._ended: dict[str, str | None] = {}
        self._lock = threading.Lock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (p.name, str(p.runId), p.batchId, p.timestamp, p.numInputRows,
               sum(s.numRowsTotal for s in p.stateOperators),
               sum(s.numRowsDroppedByWatermark for s in p.stateOperators), p.batchDuration / 1000)
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self.every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended[str(event.runId)] = event.exception

    def flush(self) -> None:
        """Append what has come since the last time."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            self.spark.createDataFrame(rows, SCHEMA.replace("at TIMESTAMP", "at STRING")) \
                .withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(self.path)

    def close(self, queries: list[StreamingQuery] = (), seconds: float = 60) -> DataFrame:
        """Wait for the last progress of ``queries``, which have ended (the
        session tells of it a little later), and return all that was kept."""
        wanted = {str(q.runId) for q in queries}
        until = time.monotonic() + seconds
        while time.monotonic() < until and not wanted <= set(self._ended):
            time.sleep(0.05)
        if missing := wanted - set(self._ended):
            raise TimeoutError(f"no end of {len(missing)} queries was told")
        self.spark.streams.removeListener(self)
        self.flush()
        return self.spark.read.schema(SCHEMA).parquet(self.path)
