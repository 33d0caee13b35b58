"""Routing of late readings: accepted ones to the day roll-up, rejected ones
to their own stream.

Two rules:

* ``"flag"`` (the reference's): the value text carries a letter ``f``.
  The text is tested *before* the cast, since Spark reads ``"0.44f"`` as
  0.44. A NULL value text is in neither branch (``contains`` gives NULL).
* ``"arrival"``: a reading is rejected when its event time lies more than
  ``delay`` before its arrival time, the stateless form of a watermark.

Both branches are filters and projections of the same input: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.functions.parse import LATE_FLAG


def split_late(df: DataFrame, value: str = "Val", ts: str = "DateTime", rule: str = "flag",
               flag: str = LATE_FLAG, arrival: str | None = None, delay: str | None = None,
               out_value: str = "NumVal") -> tuple[DataFrame, DataFrame]:
    """Return ``(accepted, rejected)``; both carry ``out_value DOUBLE`` in
    place of the value text."""
    others = [c for c in df.columns if c != value]
    if rule == "flag":
        is_late = F.col(value).contains(flag)
        num = F.regexp_replace(F.col(value), flag, "").try_cast("double")
        accepted = df.where(~is_late).select(*others, F.col(value).try_cast("double").alias(out_value))
        rejected = df.where(is_late).select(*others, num.alias(out_value))
        return accepted, rejected
    if rule == "arrival":
        if arrival is None or delay is None:
            raise ValueError("rule='arrival' needs arrival= and delay=")
        is_late = F.col(ts) < F.col(arrival) - F.expr(f"INTERVAL {delay}")
        num = F.col(value) if dict(df.dtypes)[value] == "double" else F.col(value).try_cast("double")
        accepted = df.where(~is_late).select(*others, num.alias(out_value))
        rejected = df.where(is_late).select(*others, num.alias(out_value))
        return accepted, rejected
    raise ValueError("rule is 'flag' or 'arrival'")
