"""Keyed stateful operators, the keyed store, retention, the streaming join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridsense.operators.leak import leak
from gridsense.plans.jobs import SUB_SCHEMA, TOTAL_SCHEMA, panel
from gridsense.sources import keyed_store
from gridsense.sources.io import read_topic, write_topic
from gridsense.streaming import keyed
from gridsense.streaming.marks import list_folders, list_names, note, noted
from gridsense.streaming.retention import compact
from gridsense.streaming.sinks import (read_revisions, run_available, start_topic_sink, stream_revisions,
                                       wait_for)
from tests.conftest import ts

READING = "Sensor STRING, DateTime TIMESTAMP, NumVal DOUBLE"
ONCE = {"availableNow": True}


def _put(spark, path, rows):
    spark.createDataFrame([(s, ts(t), v) for s, t, v in rows], READING).coalesce(1).write.mode("append").parquet(path)


def _stream(spark, path):
    return spark.readStream.schema(READING).parquet(path)


def _run(df, out, **kw):
    with keyed.rocksdb(df.sparkSession):
        q = start_topic_sink(df, out, trigger=ONCE, **kw)
    wait_for([q])
    return q


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_gauges_out_of_step_lose_nothing(spark, workdir):
    """Two gauges 60 days apart, one source, each day once; late rows at the side."""
    src, out = f"{workdir}/src", f"{workdir}/out"
    runs = [[("a", "2023-03-01 05:00:00", 1.5), ("a", "2023-03-01 06:00:00", 2.5), ("a", "2023-03-02 06:00:00", 4.0)],
            [("b", "2023-01-01 05:00:00", 1.0), ("b", "2023-01-02 05:00:00", 3.0)],
            [("a", "2023-03-01 23:00:00", 9.0), ("a", "2023-03-03 01:00:00", 9.0), ("b", "2023-01-02 05:00:00", None)],
            [("b", "2023-01-03 00:00:01", 7.0), (None, "2023-01-03 00:00:01", 7.0)]]
    for rows in runs:
        _put(spark, src, rows)
        q = _run(keyed.keyed_rollup(_stream(spark, src), "1 second", average=["b"]), out, partition_by=["kind"])
        assert len(q.recentProgress[-1]["sources"]) == 1
    got = _rows(spark.read.parquet(out), "Sensor", "kind", F.col("Day").cast("string"), "Total", "n")
    assert got == [("a", "accepted", "2023-03-02 00:00:00", 4.0, 2), ("a", "accepted", "2023-03-03 00:00:00", 4.0, 1),
                   ("a", "late", "2023-03-02 00:00:00", 9.0, 1), ("b", "accepted", "2023-01-02 00:00:00", 1.0, 1),
                   ("b", "accepted", "2023-01-03 00:00:00", 3.0, 1)]
    held = _rows(keyed.open_windows(spark, f"{out}.checkpoint"), "Sensor", F.col("Day").cast("string"), "Total", "n")
    assert held == [("a", "2023-03-04 00:00:00", 9.0, 1), ("b", "2023-01-04 00:00:00", 7.0, 1)]


def test_keyed_rollup_of_rejected_readings_has_bounded_state(spark, workdir):
    """Ten-minute windows: state ends with the delay, nothing is lost."""
    src, out = f"{workdir}/src", f"{workdir}/out"
    n = 0
    for day in range(1, 5):
        rows = [("w", f"2023-01-{day:02d} {h:02d}:0{m}:00", 0.25) for h in range(0, 24, 3) for m in (3, 8)]
        rows += [("w", f"2022-12-{day + 10:02d} 00:01:00", 1.0)]
        n += len(rows)
        _put(spark, src, rows)
        _run(keyed.keyed_rollup(_stream(spark, src), "1 day", period="10 minutes", round_to=None), out)
        held = keyed.open_windows(spark, f"{out}.checkpoint", period="10 minutes", round_to=None)
        assert held.count() <= 2 * 8 + 1
    closed = spark.read.parquet(out)
    assert closed.agg(F.sum("n")).first()[0] + held.agg(F.sum("n")).first()[0] == n
    assert closed.where("kind = 'late'").count() == 3  # the first batch has no watermark yet


def test_values_without_a_decimal_are_summed_as_doubles(spark, workdir):
    src, out = f"{workdir}/src", f"{workdir}/out"
    _put(spark, src, [("a", "2023-01-01 01:00:00", 1e30), ("a", "2023-01-01 02:00:00", 1.0),
                      ("b", "2023-01-01 01:00:00", 0.1), ("b", "2023-01-01 02:00:00", 0.2),
                      ("a", "2023-01-03 00:00:00", 0.0), ("b", "2023-01-03 00:00:00", 0.0)])
    _run(keyed.keyed_rollup(_stream(spark, src), "1 second", round_to=None), out)
    assert _rows(spark.read.parquet(out), "Sensor", "Total") == [("a", 1e30), ("b", 0.3)]


def test_counter_state_is_constant_over_a_year(spark, workdir):
    src, out = f"{workdir}/src", f"{workdir}/out"
    start = dt.date(2023, 1, 1)
    rows = [("m", f"{start + dt.timedelta(days=d)} 00:00:00", 10.0 * d + d % 7) for d in range(365)]
    held_back = rows.pop(40)
    sizes = []
    for part in (rows[:42] + [("m", "2023-01-05 09:00:00", 999.0)], [held_back], rows[42:200], rows[200:]):
        _put(spark, src, part)
        q = _run(keyed.keyed_counter_diff(_stream(spark, src)), out, mode="update")
        sizes.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(sizes) == min(sizes) == 1  # one row of state for the counter
    days = spark.read.format("statestore").option("stateVarName", "firsts").load(f"{out}.checkpoint") \
        .select(F.size("value.day")).first()[0]
    assert days == 7
    got = _rows(read_revisions(spark, out, ["Sensor", "Day"]), F.col("Day").cast("date"), "daily_diff")
    value = {d: 10.0 * d + d % 7 for d in range(365)}
    assert got == [(start + dt.timedelta(days=d), value[d] - value[d - 1]) for d in range(1, 365)]


def test_the_application_with_bounded_counters_and_compaction(spark, workdir):
    from gridsense import registry
    from gridsense.plans import jobs
    from gridsense.sources.io import read_messages
    topic = {s.name: s.topic for s in registry.HOUSEHOLD}
    for d in range(1, 13):
        rows = [(topic["Wtot"], f"2023-01-{d:02d} 00:00:00 | {100.0 * d}"), (topic["W1"], f"2023-01-{d:02d} 03:00:00 | 60.0")]
        spark.createDataFrame(rows, "topic STRING, payload STRING").coalesce(1).write.mode("append").parquet(f"{workdir}/src")
    topics, store = f"{workdir}/topics", f"{workdir}/store"
    sensors = [s for s in registry.HOUSEHOLD if s.name in ("W1", "Wtot")]
    for _ in range(2):  # the second run compacts what the first one's readers have read
        msgs = read_messages(spark, f"{workdir}/src", stream=True, max_files_per_trigger=1)
        wait_for(jobs.start_household(msgs, topics, sensors=sensors, trigger=ONCE, raw=False, compact_every=4,
                                      store_root=store, counter_days=3))
        wait_for([jobs.start_leak(spark, topics, trigger=ONCE)])
        wait_for(jobs.start_store(spark, topics, store, names=["counter_diff", "leak"], trigger=ONCE))
        spark.createDataFrame([(topic["Wtot"], "2023-01-13 00:00:00 | 1300.0"), (topic["W1"], "2023-01-12 23:00:00 | 5.0")],
                              "topic STRING, payload STRING").coalesce(1).write.mode("append").parquet(f"{workdir}/src")
    got = _rows(jobs.read_store(spark, store, "counter_diff"), F.dayofmonth("Day"), "daily_diff")
    assert got == [(d, 100.0) for d in range(2, 14)]
    leaks = _rows(jobs.read_store(spark, store, "leak"), F.dayofmonth("Day"), "LeakValue")
    assert leaks == [(d, 40.0) for d in range(2, 13)] + [(13, 35.0)]


# -- the join ------------------------------------------------------------------------

def _days(spark, path, col, values):
    rows = [(ts(f"2023-01-01 00:00:00") + dt.timedelta(days=d), v) for d, v in values]
    write_topic(spark.createDataFrame(rows, f"Day TIMESTAMP, {col} DOUBLE").coalesce(1), path)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_streaming_join_holds_and_lets_go(spark, workdir, how):
    """Forty days, four a batch, the meter one batch behind; two days without a meter."""
    missing, sizes = {9, 22}, []
    for k in range(0, 40, 4):
        _days(spark, f"{workdir}/sub", "Totalw1", [(d, 1.0 * d) for d in range(k, k + 4)])
        _days(spark, f"{workdir}/total", "daily_diff", [(d, 3.0 * d) for d in range(max(0, k - 4), k) if d not in missing])
        joined = leak(read_topic(spark, f"{workdir}/sub", SUB_SCHEMA, stream=True),
                      read_topic(spark, f"{workdir}/total", TOTAL_SCHEMA, stream=True), watermark="5 seconds", how=how)
        q = start_topic_sink(joined, f"{workdir}/leak", fmt="json", trigger=ONCE)
        wait_for([q])
        sizes.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(sizes[2:]) <= 10 and sizes[-1] <= sizes[2]  # what is matched and passed is let go
    schema = "Day TIMESTAMP, Totalw1 DOUBLE, LeakValue DOUBLE"
    got = _rows(read_topic(spark, f"{workdir}/leak", schema), F.dayofyear("Day") - 1, "LeakValue")
    want = [(d, 2.0 * d) for d in range(36) if d not in missing]
    assert [r for r in got if r[1] is not None] == want
    assert [r[0] for r in got if r[1] is None] == (sorted(missing) if how == "left" else [])


def test_join_refuses_other_forms(spark):
    df = spark.createDataFrame([], SUB_SCHEMA)
    with pytest.raises(ValueError):
        leak(df, spark.createDataFrame([], TOTAL_SCHEMA), how="full")


# -- the keyed store ------------------------------------------------------------------

RESULT = "Sensor STRING, Day TIMESTAMP, Total DOUBLE, batch_id LONG"


def _result(spark, rows):
    return spark.createDataFrame([(s, ts(f"{d} 00:00:00"), v, b) for s, d, v, b in rows], RESULT)


def test_keyed_store_has_one_row_per_key_on_disk(spark, workdir):
    path = f"{workdir}/daily"

    def put(version, rows):
        keyed_store.merge(_result(spark, rows), path, ["Sensor", "Day"], "batch_id", version, "Day", buckets=8)

    put(0, [(s, f"2023-0{m}-0{d}", 1.0, 0) for s in "abc" for m in (1, 2, 3) for d in (1, 2)])
    put(1, [("a", "2023-01-01", 5.0, 1), ("a", "2023-01-01", 4.0, 0), ("d", "2023-01-01", 2.0, 1)])
    put(1, [("a", "2023-01-01", 77.0, 9)])  # repeated after its switch: nothing
    put(2, [("a", "2023-01-01", 3.0, 0)])  # an older revision: the later stays
    put(3, [])
    df = keyed_store.read_keyed(spark, path, buckets=8)
    assert df.count() == 19 == df.select("Sensor", "Day").distinct().count()
    on_disk = spark.read.option("recursiveFileLookup", True).parquet(*[
        f"{path}/v={v}/bucket={b}" for b, v in keyed_store._manifest(spark, path).items()])
    assert on_disk.count() == 19
    one = keyed_store.read_keyed(spark, path, "a", "2023-01-01", "2023-01-20", buckets=8)
    assert _rows(one, "Sensor", "Total") == [("a", 1.0), ("a", 5.0)]
    assert len({f.rsplit("/", 2)[-2] for f in one.inputFiles()}) == 1  # one bucket is opened
    none = keyed_store.read_keyed(spark, path, "zz", "2023-01-01", "2023-01-20", buckets=8)
    assert none.count() == 0
    # versions that the last two manifests do not name are gone
    assert len(list_folders(spark, f"{path}_manifests", "n=")) <= 2
    named = set(keyed_store._manifest(spark, path).values())
    assert set(list_folders(spark, path, "v=")) - {2, 3} <= named | {1}


def test_a_merge_that_failed_before_its_switch_is_written_over(spark, workdir):
    path = f"{workdir}/daily"
    args = (["Sensor", "Day"], "batch_id")
    keyed_store.merge(_result(spark, [("a", "2023-01-01", 1.0, 0)]), path, *args, 0, "Day")
    _result(spark, [("x", "2023-01-01", 9.0, 1)]).withColumn("bucket", F.lit(3)) \
        .write.partitionBy("bucket").parquet(f"{path}/v=1")
    assert keyed_store.read_keyed(spark, path).count() == 1
    keyed_store.merge(_result(spark, [("b", "2023-01-01", 2.0, 1)]), path, *args, 1, "Day")
    assert _rows(keyed_store.read_keyed(spark, path), "Sensor", "Total") == [("a", 1.0), ("b", 2.0)]


def test_panel_reads_a_keyed_dataset(spark, workdir):
    rows = [("TH2", f"2023-01-0{d}", 20.0 + d, d) for d in range(1, 8)] + [("TH1", "2023-01-02", 9.0, 0)]
    keyed_store.merge(_result(spark, rows), f"{workdir}/daily", ["Sensor", "Day"], "batch_id", 0, "Day")
    got = panel(spark, workdir, "th2_daily_avg", "2023-01-02 00:00:00", "2023-01-04 00:00:00")
    assert got.columns == ["Sensor", "Day", "Total"] and _rows(got, "Total") == [(22.0,), (23.0,), (24.0,)]


def test_a_dataset_without_rows(spark, workdir):
    keyed_store.merge(_result(spark, []), f"{workdir}/daily", ["Sensor", "Day"], "batch_id", 0, "Day")
    assert keyed_store.read_keyed(spark, f"{workdir}/daily", schema=RESULT).count() == 0
    with pytest.raises(FileNotFoundError):
        keyed_store.read_keyed(spark, f"{workdir}/daily")


def test_marks(spark, workdir):
    assert noted(spark, f"{workdir}/m") is None
    for n in (0, 1, 5, 7):
        note(spark, f"{workdir}/m", n)
    assert noted(spark, f"{workdir}/m") == 7 and len(list_names(spark, f"{workdir}/m")) == 2


# -- retention ----------------------------------------------------------------------------

def test_retention_bounds_files_and_readers_go_on(spark, workdir):
    """Forty micro-batches, compacted every ten; a reader that is started again
    and again gets every revision, batch readers the same rows."""
    src, topic, copy = (f"{workdir}/{x}" for x in ("src", "daily", "copy"))
    schema, keys = "Sensor STRING, Day TIMESTAMP, Total DOUBLE", ["Sensor", "Day"]
    most = 0
    for part in range(4):
        for k in range(10):
            d = part * 10 + k
            _put(spark, src, [("a", f"2023-01-{1 + d % 28:02d} 0{k}:00:00", 1.0), ("b", "2023-01-01 01:00:00", 1.0)])
        daily = spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(src) \
            .groupBy("Sensor", F.window("DateTime", "1 day").alias("w")).agg(F.sum("NumVal").alias("Total")) \
            .select("Sensor", F.col("w.end").alias("Day"), "Total")
        wait_for([start_topic_sink(daily, topic, fmt="json", mode="update", trigger=ONCE, compact=(
            10, lambda s: compact(s, topic, keys, [f"{copy}.checkpoint"], json_schema=schema)))])
        run_available(stream_revisions(spark, topic, schema), copy)
        most = max(most, len(list_folders(spark, topic, "batch_id=")))
    compact(spark, topic, keys, [f"{copy}.checkpoint"], json_schema=schema)
    assert most <= 20 and len(list_folders(spark, topic, "batch_id=")) <= 1
    assert len(list_folders(spark, f"{topic}_snapshots", "upto=")) <= 2
    want = spark.read.parquet(src).groupBy("Sensor", (F.to_date("DateTime") + F.expr("INTERVAL 1 DAY")).cast("timestamp")
                                           .alias("Day")).agg(F.sum("NumVal").alias("Total"))
    want = _rows(want, *keys, "Total")
    assert _rows(read_revisions(spark, topic, keys, json_schema=schema), *keys, "Total") == want
    # the streaming reader has seen every revision, those of removed folders too
    seen = spark.read.parquet(copy)
    assert seen.select("batch_id").distinct().count() == 40
    latest = seen.groupBy(*keys).agg(F.max_by("Total", "batch_id").alias("Total"))
    assert _rows(latest, *keys, "Total") == want


def test_folders_that_no_reader_has_read_stay(spark, workdir):
    topic = f"{workdir}/daily"
    src = f"{workdir}/src"
    _put(spark, src, [("a", "2023-01-01 01:00:00", 1.0)])
    sums = _stream(spark, src).groupBy("Sensor").agg(F.sum("NumVal").alias("Total"))
    run_available(sums, topic, fmt="json", mode="update")
    schema = "Sensor STRING, Total DOUBLE"
    assert compact(spark, topic, ["Sensor"], [f"{workdir}/nobody"], json_schema=schema) == 0
    assert list_folders(spark, topic, "batch_id=") == [0]
    assert compact(spark, topic, ["Sensor"], json_schema=schema) == 1
    assert _rows(read_revisions(spark, topic, ["Sensor"], json_schema=schema), "Sensor", "Total") == [("a", 1.0)]
