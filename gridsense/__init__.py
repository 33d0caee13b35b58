"""gridsense: household sensor-stream analytics on Spark DataFrames.

Readings arrive as ``"<timestamp> | <value>"`` messages per sensor topic; the
library parses them, rolls them up by day and sensor, takes daily
differences of cumulative meters, routes late readings, computes leaks by
joining derived streams and keeps results as Parquet datasets. Every
operator is a DataFrame function that works on batch input and, with a
watermark, on Structured Streaming input.
"""

from gridsense.functions.parse import (decode_json, drop_invalid, encode_json, format_payload,
                                       parse_reading, raw_envelope, sensor_from_topic)
from gridsense.operators.counter import counter_daily_diff
from gridsense.operators.late import split_late
from gridsense.operators.leak import latest_per_key, leak
from gridsense.operators.rollup import (daily_rollup, plausible, rejected_rollup, watermark,
                                        window_rollup)
from gridsense.session import get_session, work_dir
from gridsense.streaming.sinks import (read_revisions, run_all, run_available, snapshot_revisions,
                                       start_topic_sink, stream_revisions)

__all__ = [
    "counter_daily_diff", "daily_rollup", "decode_json", "drop_invalid", "encode_json",
    "format_payload", "get_session", "latest_per_key", "leak", "parse_reading", "plausible",
    "raw_envelope", "read_revisions", "rejected_rollup", "run_all", "run_available",
    "sensor_from_topic", "snapshot_revisions", "split_late", "start_topic_sink",
    "stream_revisions", "watermark", "window_rollup", "work_dir",
]
