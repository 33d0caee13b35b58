"""Leak = metered total - sum of its sub-meters, and the last revision per key.

``leak`` joins two *derived* tables on their day label. Both sides are
already aggregated (one row per key and day), so the join moves days, not
readings; Spark (with AQE) broadcasts a side only when its runtime size is
under ``spark.sql.autoBroadcastJoinThreshold``, otherwise it shuffles both
sides on the key. No hint is forced here, because the number of keys
(households x days) has no fixed bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.operators.rollup import _keys


def latest_per_key(df: DataFrame, keys: str | Sequence[str], order: str,
                   cols: Sequence[str] | None = None, keep_order: bool = False) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (a revision or
    batch id). Later revisions replace earlier ones, as an upsert by key does.

    Built as one ``max_by(col, order)`` per column, so the reduction is
    partial before the shuffle and, for fixed-width columns, a hash
    aggregate: a key with very many revisions never lands whole in one task
    (a ``row_number`` window would sort them all there). ``order`` must be
    unique within a key, as a batch id is, so that all columns come from the
    same revision. ``keep_order`` also returns the winning ``order``.
    """
    keys = _keys(keys)
    cols = [c for c in (cols or df.columns) if c not in keys and c != order]
    aggs = [F.max_by(c, order).alias(c) for c in cols]
    if keep_order:
        aggs.append(F.max(order).alias(order))
    return df.groupBy(*keys).agg(*aggs)


def leak(sub_df: DataFrame, total_df: DataFrame, day: str = "Day", sub: str = "Totalw1",
         total: str = "daily_diff", by=None, out: str = "LeakValue",
         round_to: int | None = 2, watermark: str | None = None,
         sum_subs: bool = False, revision: str | None = None, how: str = "inner") -> DataFrame:
    """``(keys, Day, LeakValue = total - sub)`` for days present on both sides.

    * ``how="left"``: also the sub-meter's days without a meter, with a NULL
      leak, and the sub-meter's sum; in a stream such a day leaves once both
      sides' watermark has passed it.
    * ``sum_subs``: ``sub_df`` holds several sub-meters per day; they are
      summed first (batch only).
    * ``revision``: both sides are revision logs (update-mode output); the
      last revision per day is taken before the join, so a day gives one row.
    * ``watermark``: stream-stream inner join (append mode), both sides
      watermarked on their day label; the query's watermark follows the
      slower side, so a day's state is dropped once both have passed it.
    """
    keys = _keys(by)
    if revision is not None:
        sub_df = latest_per_key(sub_df, [*keys, day], revision, [sub])
        total_df = latest_per_key(total_df, [*keys, day], revision, [total])
    if sum_subs:
        sub_df = sub_df.groupBy(*keys, day).agg(F.sum(sub).alias(sub))
    left = sub_df.select(*keys, day, sub)
    right = total_df.select(*[F.col(k).alias(f"_{k}_2") for k in keys],
                            F.col(day).alias("_day_2"), F.col(total))
    if watermark is not None:
        left = left.withWatermark(day, watermark)
        right = right.withWatermark("_day_2", watermark)
    cond = F.col(day) == F.col("_day_2")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_{k}_2"))
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    joined = left.join(right, cond, how)
    value = F.col(total) - F.col(sub)
    if round_to is not None:
        value = F.round(value, round_to)
    return joined.select(*keys, F.col(day), *([sub] if how == "left" else []), value.alias(out))


def leak_of_revisions(sub_df: DataFrame, total_df: DataFrame, revision: str, day: str = "Day",
                      sub: str = "Totalw1", total: str = "daily_diff", by=None,
                      out: str = "LeakValue", round_to: int | None = 2) -> DataFrame:
    """The leak over two logs of revisions, batch or streaming (update mode).

    Both logs are united and each key keeps the latest revision of either
    side, so a row leaves as soon as both sides are known and again whenever
    one of them is revised. The state is one row per key and day; nothing is
    joined and nothing is withheld by a watermark.
    """
    keys = _keys(by)
    none = F.lit(None)
    left = sub_df.select(*keys, day, F.col(sub).alias("_sub"), F.col(revision).alias("_sub_at"),
                         none.cast("double").alias("_total"), none.cast("long").alias("_total_at"))
    right = total_df.select(*keys, day, none.cast("double").alias("_sub"), none.cast("long").alias("_sub_at"),
                            F.col(total).alias("_total"), F.col(revision).alias("_total_at"))
    last = left.unionByName(right).groupBy(*keys, day).agg(
        F.max_by("_sub", "_sub_at").alias("_sub"), F.max_by("_total", "_total_at").alias("_total"))
    value = F.col("_total") - F.col("_sub")
    if round_to is not None:
        value = F.round(value, round_to)
    return last.where(F.col("_sub").isNotNull() & F.col("_total").isNotNull()) \
        .select(*keys, day, value.alias(out))
