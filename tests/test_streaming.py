"""Streams: batch = stream, late rows against a watermark, update-mode
revisions, the two-stage leak, and restart from a checkpoint."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridsense import registry
from gridsense.operators.counter import counter_daily_diff
from gridsense.operators.late import split_late
from gridsense.operators.leak import latest_per_key, leak_of_revisions
from gridsense.operators.rollup import daily_rollup
from gridsense.session import new_work_path
from gridsense.plans import queries as q_
from gridsense.plans.jobs import (KEYS, PANELS, SUB_SCHEMA, TOPIC_SCHEMAS, TOTAL_SCHEMA, gauge_daily,
                                  leak_job, panel, sensor_readings, start_household, start_leak,
                                  start_raw_store, start_store)
from gridsense.sources.io import read_messages, read_topic
from gridsense.streaming.sinks import (read_revisions, run_all, run_available, snapshot_revisions,
                                      start_topic_sink, wait_for)
from tests.conftest import SF001, ts


def _write_batches(spark, path, batches):
    """Each list of (topic, payload) becomes its own file, written in order."""
    for rows in batches:
        spark.createDataFrame(rows, "topic STRING, payload STRING").coalesce(1) \
            .write.mode("append").parquet(path)


TOPIC = {s.name: s.topic for s in registry.HOUSEHOLD}


def _gauge(day, hour, value, sensor="HVAC1"):
    return (TOPIC[sensor], f"2023-01-{day:02d} {hour:02d}:00:00 | {value}")


def test_stream_equals_batch_minus_open_windows(spark, workdir):
    batches = [[_gauge(d, h, float(d + h)) for h in (0, 6, 12, 18)] for d in range(1, 6)]
    src = f"{workdir}/src"
    _write_batches(spark, src, batches)
    stream = read_messages(spark, src, stream=True, max_files_per_trigger=1)
    out = run_available(gauge_daily(sensor_readings(stream), delay="1 second"), f"{workdir}/out")
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = gauge_daily(sensor_readings(read_messages(spark, src)))
    # the last day's window is still open: its end is past the watermark
    want = sorted(tuple(r) for r in batch.where(F.col("Day") <= "2023-01-05").collect())
    assert got == want and len(got) == 4


def _w1(day, hour=12, value=1.0, flag=""):
    return ("IoT/water/W1", f"2023-01-{day:02d} {hour:02d}:00:00 | {value}{flag}")


def _accepted_stream(spark, src):
    r = sensor_readings(read_messages(spark, src, stream=True, max_files_per_trigger=1), numeric=False)
    acc, _ = split_late(r)
    return daily_rollup(acc, delay="3 days", out="Totalw1")


def test_two_days_late_counted_ten_days_late_dropped(spark, workdir):
    src = f"{workdir}/src"
    _write_batches(spark, src, [
        [_w1(13, value=5.0)],            # watermark moves to 01-10 12:00
        [_w1(11, value=2.0)],            # 2 days late: kept
        [_w1(3, value=7.0)],             # 10 days late: dropped
        [_w1(14, value=1.0)],
    ])
    q = start_topic_sink(_accepted_stream(spark, src), f"{workdir}/out", mode="update",
                         trigger={"availableNow": True})
    q.awaitTermination()
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p["stateOperators"])
    final = latest_per_key(spark.read.parquet(f"{workdir}/out"), "Day", "batch_id")
    got = sorted(tuple(r) for r in final.collect())
    assert got == [(ts("2023-01-12 00:00:00"), 2.0), (ts("2023-01-14 00:00:00"), 5.0),
                   (ts("2023-01-15 00:00:00"), 1.0)]
    assert dropped == 1


def test_update_mode_revisions_resolve_to_final_sum(spark, workdir):
    src = f"{workdir}/src"
    _write_batches(spark, src, [[_w1(1, 1, 10.0)], [_w1(1, 2, 15.0)], [_w1(1, 3, 20.0), _w1(2, 1, 50.0)]])
    out = run_available(_accepted_stream(spark, src), f"{workdir}/out", mode="update")
    revs = spark.read.parquet(out)
    assert revs.where(F.col("Day") == "2023-01-02").count() == 3  # one revision per batch
    final = sorted(tuple(r) for r in latest_per_key(revs, "Day", "batch_id").collect())
    assert final == [(ts("2023-01-02 00:00:00"), 45.0), (ts("2023-01-03 00:00:00"), 50.0)]


def test_restart_resumes_from_checkpoint(spark, workdir):
    src = f"{workdir}/src"
    _write_batches(spark, src, [[_gauge(d, 1, 1.0)] for d in range(1, 4)])
    df = gauge_daily(sensor_readings(read_messages(spark, src, stream=True)), delay="1 second")
    out, ck = f"{workdir}/out", f"{workdir}/ck"
    run_available(df, out, checkpoint=ck)
    first = spark.read.parquet(out).count()
    _write_batches(spark, src, [[_gauge(d, 1, 1.0)] for d in range(4, 6)])
    df2 = gauge_daily(sensor_readings(read_messages(spark, src, stream=True)), delay="1 second")
    run_available(df2, out, checkpoint=ck)
    days = sorted(r.Day for r in spark.read.parquet(out).collect())
    assert first == 2
    assert days == [ts(f"2023-01-0{d} 00:00:00") for d in range(2, 6)]  # no duplicates


def test_two_stage_stream_leak(spark, workdir):
    src = f"{workdir}/src"
    w1 = [_w1(d, h, 2.0) for d in range(1, 9) for h in (3, 15)]
    wtot = [("IoT/water/Wtot", f"2023-01-{d:02d} 00:00:00 | {100.0 + 10 * d}") for d in range(2, 10)]
    _write_batches(spark, src, [w1 + wtot])
    stream = read_messages(spark, src, stream=True)
    r = sensor_readings(stream, ["W1"], numeric=False)
    acc, _ = split_late(r)
    sub = run_available(daily_rollup(acc, delay="3 days", out="Totalw1"), f"{workdir}/sub", fmt="json",
                        json_cols=["Day", "Totalw1"])
    tot = run_available(counter_daily_diff(sensor_readings(stream, ["Wtot"]), delay="1 second"),
                        f"{workdir}/tot", fmt="json", json_cols=["Day", "daily_diff"])
    joined = leak_job(read_topic(spark, sub, SUB_SCHEMA, stream=True),
                      read_topic(spark, tot, TOTAL_SCHEMA, stream=True), watermark="5 seconds")
    out = run_available(joined, f"{workdir}/leak")
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    # W1 days end 01-02..01-09, closed up to 01-05 (watermark 01-05 15:00);
    # counter pairs labelled 01-03..01-09, closed while label + 1 day <= 01-08 23:59:59.
    assert got == [(ts(f"2023-01-0{d} 00:00:00"), 6.0) for d in (3, 4, 5)]


def _household_rows(d):
    return [_gauge(d, 1, 1.0), _gauge(d, 2, 3.0, "MiAC1"), _w1(d, 5, 0.5),
            ("IoT/temperature/TH1", f"2023-01-{d:02d} 04:00:00 | 20.0"),
            ("IoT/water/Wtot", f"2023-01-{d:02d} 00:00:00 | {100.0 * d}"),
            ("IoT/energy/Etot", f"2023-01-{d:02d} 00:00:00 | {1000.0 * d}")]


ONCE = {"trigger": {"availableNow": True}}


def _topic(spark, topics, name):
    rows = read_revisions(spark, f"{topics}/{name}", KEYS[name], json_schema=TOPIC_SCHEMAS[name])
    return sorted(tuple(r) for r in rows.collect())


def _run_household(spark, src, topics, store, max_files=None):
    msgs = read_messages(spark, src, stream=True, max_files_per_trigger=max_files)
    wait_for([*start_household(msgs, topics, name_prefix="t_", **ONCE), start_raw_store(msgs, store, **ONCE)])
    wait_for([start_leak(spark, topics, name_prefix="t_", **ONCE)])
    wait_for(start_store(spark, topics, store, **ONCE))


def test_household_application_twice(spark, workdir):
    src, topics, store = f"{workdir}/src", f"{workdir}/topics", f"{workdir}/store"
    _write_batches(spark, src, [[r for d in range(1, 6) for r in _household_rows(d)]])
    before = None
    for _ in range(2):  # the second run has nothing new and changes nothing
        _run_household(spark, src, topics, store)
        assert {(r[0], r[2]) for r in _topic(spark, topics, "daily")} == {("HVAC1", 1.0), ("MiAC1", 3.0), ("TH1", 20.0)}
        assert [(r[0], r[2]) for r in _topic(spark, topics, "counter_diff")] == [("Etot", 1000.0)] * 4 + [("Wtot", 100.0)] * 4
        assert _topic(spark, topics, "leak") == [("Wtot", ts(f"2023-01-0{d} 00:00:00"), 99.5) for d in (2, 3, 4, 5)]
        rows = {name: sorted(map(str, panel(spark, store, name).collect())) for name in PANELS}
        assert before in (None, rows)
        before = rows
    assert [len(rows[n]) for n in ("th1_raw", "w1_raw", "etot_diff", "water_leak")] == [5, 5, 4, 4]
    # A revised day replaces its row.
    _write_batches(spark, src, [[_w1(4, 6, 1.0), *_household_rows(6)]])
    _run_household(spark, src, topics, store)
    leak = {r.Day: r.LeakValue for r in panel(spark, store, "water_leak").collect()}
    assert leak == {ts(f"2023-01-0{d} 00:00:00"): 98.5 if d == 5 else 99.5 for d in range(2, 7)}
    assert panel(spark, store, "th1_raw", start="2023-01-06 00:00:00").count() == 1


def test_no_reading_is_lost_with_sensors_out_of_step(spark, workdir):
    """One file per sensor, each in order in itself, far apart: every label
    of every sensor comes out."""
    src, topics = f"{workdir}/src", f"{workdir}/topics"
    late = [("IoT/water/W1", "2023-01-25 01:00:00 | 0.5f"), ("IoT/water/W1", "2023-01-22 01:00:00 | 0.5f")]
    _write_batches(spark, src, [
        [_gauge(d, 1, 1.0) for d in range(1, 28)],
        [("IoT/temperature/TH1", f"2023-01-{d:02d} 04:00:00 | 20.0") for d in range(1, 6)],
        [("IoT/energy/Etot", f"2023-01-{d:02d} 00:00:00 | {1000.0 * d}") for d in range(1, 28)],
        [("IoT/water/Wtot", f"2023-01-{d:02d} 00:00:00 | {100.0 * d}") for d in range(1, 6)],
        [_w1(d, 5, 0.5) for d in range(1, 5)], late[:1], late[1:]])
    msgs = read_messages(spark, src, stream=True, max_files_per_trigger=1)
    wait_for(start_household(msgs, topics, name_prefix="o_", **ONCE))
    wait_for([start_leak(spark, topics, name_prefix="o_", **ONCE)])
    daily, diff = _topic(spark, topics, "daily"), _topic(spark, topics, "counter_diff")
    assert [r[1].day for r in daily if r[0] == "TH1"] == [2, 3, 4, 5, 6]
    assert [r[1].day for r in daily if r[0] == "HVAC1"] == list(range(2, 29))
    assert [r[1].day for r in diff if r[0] == "Wtot"] == [2, 3, 4, 5]
    assert [r[1].day for r in _topic(spark, topics, "rejected")] == [22, 25]
    assert [r[1].day for r in _topic(spark, topics, "leak")] == [2, 3, 4, 5]


def test_gauges_of_a_backlog_months_apart_lose_nothing(spark, workdir):
    """One sensor per file and batch, 60 days apart, without a delay or with
    one: every day of both comes out."""
    src = f"{workdir}/src"
    th1 = [("IoT/temperature/TH1", f"2023-01-{d:02d} 04:00:00 | 20.0") for d in range(1, 6)]
    # Lateness is judged by the watermark of the batch before, hence the batch between.
    _write_batches(spark, src, [[(TOPIC["HVAC1"], f"2023-03-{d:02d} 01:00:00 | 1.0") for d in days]
                                for days in (range(2, 6), range(6, 8))] + [th1[:4], th1[4:]])
    msgs = read_messages(spark, src, stream=True, max_files_per_trigger=1)
    for k, delay in enumerate(({}, {"gauge_delay": "3 days"})):
        wait_for(start_household(msgs, f"{workdir}/topics{k}", name_prefix=f"m{k}_", raw=False, **delay, **ONCE))
        daily = _topic(spark, f"{workdir}/topics{k}", "daily")
        assert [r[1].day for r in daily if r[0] == "TH1"] == [2, 3, 4, 5, 6]
        assert [r[1].day for r in daily if r[0] == "HVAC1"] == [3, 4, 5, 6, 7, 8]


def test_sub_meters_out_of_step_lose_nothing(spark, workdir):
    src, topics = f"{workdir}/src", f"{workdir}/topics"
    subs = [registry.Sensor(n, f"IoT/water/{n}", "water", "gauge", "sum") for n in ("W1", "W2")]
    _write_batches(spark, src, [[("IoT/water/W2", "2023-03-02 01:00:00 | 1.0")], [("IoT/water/W2", "2023-03-03 01:00:00 | 1.0")],
                                [_w1(1)], [_w1(2)]])
    msgs = read_messages(spark, src, stream=True, max_files_per_trigger=1)
    wait_for(start_household(msgs, topics, sensors=subs, late_sensors=["W1", "W2"], name_prefix="w_", raw=False, **ONCE))
    assert [(r[0], r[1].day) for r in _topic(spark, topics, "accepted_daily")] == [("W1", 2), ("W1", 3), ("W2", 3), ("W2", 4)]


def test_unfinished_batches_and_removed_folders(spark, workdir):
    """A batch counts once it is committed; what a snapshot covers may go."""
    import shutil
    src, out, ck = f"{workdir}/src", f"{workdir}/out", f"{workdir}/ck"
    _write_batches(spark, src, [[_w1(1, 1, 10.0)], [_w1(1, 2, 15.0)]])
    run_available(_accepted_stream(spark, src), out, mode="update", checkpoint=ck)
    spark.createDataFrame([(ts("2023-01-02 00:00:00"), 99.0)], "Day TIMESTAMP, Totalw1 DOUBLE") \
        .write.parquet(f"{out}/batch_id=77")  # written but never committed
    assert [r.Totalw1 for r in read_revisions(spark, out, ["Day"]).collect()] == [25.0]
    upto = snapshot_revisions(spark, out, ["Day"])
    for k in (*range(upto + 1), 77):
        shutil.rmtree(f"{out}/batch_id={k}".removeprefix("file:"), ignore_errors=True)
    assert [r.Totalw1 for r in read_revisions(spark, out, ["Day"]).collect()] == [25.0]


def test_streams_of_a_folder_table_equal_those_of_a_file(spark, workdir):
    folder = f"{workdir}/tables"
    spark.read.parquet(f"{SF001}/events.parquet").repartition(4).write.parquet(f"{folder}/events.parquet")
    for name in ("stream_daily_sum", "stream_rejected", "stream_accepted_update", "stream_leak"):
        rows = [sorted(map(str, q_.QUERIES[name](spark, d).collect())) for d in (folder, SF001)]
        assert rows[0] == rows[1] and rows[0], name


def test_leak_of_revisions_in_batch(spark):
    day = ts("2023-01-02 00:00:00")
    sub = spark.createDataFrame([(day, 1.0, 0), (day, 2.0, 3), (ts("2023-01-03 00:00:00"), 5.0, 0)],
                                "Day TIMESTAMP, Totalw1 DOUBLE, batch_id LONG")
    total = spark.createDataFrame([(day, 10.0, 1), (day, 12.0, 2)], "Day TIMESTAMP, daily_diff DOUBLE, batch_id LONG")
    assert [tuple(r) for r in leak_of_revisions(sub, total, "batch_id").collect()] == [(day, 10.0)]


def _lagging_batches():
    # HVAC1 runs days ahead of MiAC1; MiAC1's next reading is then 2 days
    # behind the shared watermark but on time for its own. (Lateness is
    # judged by the watermark of the batch before, hence the batch between.)
    return [[_gauge(1, 1, 1.0), _gauge(1, 1, 2.0, "MiAC1")],
            [_gauge(5, 1, 1.0)],
            [_gauge(6, 1, 1.0)],
            [_gauge(2, 1, 2.0, "MiAC1")],
            [_gauge(9, 1, 1.0), _gauge(9, 1, 2.0, "MiAC1")]]


def _miac1_days(spark, workdir, each):
    src = f"{workdir}/src"
    _write_batches(spark, src, _lagging_batches())
    stream = sensor_readings(read_messages(spark, src, stream=True, max_files_per_trigger=1))
    out = run_available(gauge_daily(stream, delay="1 day", watermark_each=each), f"{workdir}/out")
    return sorted(r.Day for r in spark.read.parquet(out).where("Sensor = 'MiAC1'").collect())


def test_append_mode_drops_what_a_shared_watermark_has_closed(spark, workdir):
    """The operator in append mode; the application uses update mode and a
    lateness that covers sensors out of step."""
    assert _miac1_days(spark, workdir, None) == [ts("2023-01-02 00:00:00")]


def test_watermark_per_sensor_keeps_a_lagging_sensor(spark, workdir):
    days = _miac1_days(spark, workdir, ["HVAC1", "MiAC1"])
    assert days == [ts("2023-01-02 00:00:00"), ts("2023-01-03 00:00:00")]


def test_revision_snapshot_then_later_batches(spark, workdir):
    src, out = f"{workdir}/src", f"{workdir}/out"
    ck = f"{workdir}/ck"
    _write_batches(spark, src, [[_w1(1, 1, 10.0)], [_w1(1, 2, 15.0), _w1(2, 1, 50.0)]])
    run_available(_accepted_stream(spark, src), out, mode="update", checkpoint=ck)
    upto = snapshot_revisions(spark, out, ["Day"])  # last batch of the first run
    _write_batches(spark, src, [[_w1(1, 3, 20.0)], [_w1(3, 1, 7.0)]])
    run_available(_accepted_stream(spark, src), out, mode="update", checkpoint=ck)
    got = sorted((r.Day, r.Totalw1) for r in read_revisions(spark, out, ["Day"]).collect())
    want = sorted((r.Day, r.Totalw1) for r in latest_per_key(spark.read.parquet(out), "Day", "batch_id").collect())
    assert got == want == [(ts("2023-01-02 00:00:00"), 45.0), (ts("2023-01-03 00:00:00"), 50.0),
                           (ts("2023-01-04 00:00:00"), 7.0)]
    # as of the snapshot's batch only
    old = sorted((r.Day, r.Totalw1) for r in read_revisions(spark, out, ["Day"], upto=upto).collect())
    assert old == [(ts("2023-01-02 00:00:00"), 25.0), (ts("2023-01-03 00:00:00"), 50.0)]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["HVAC1", "TH1"]), st.integers(0, 6 * 96 - 1),
                          st.integers(0, 500)), min_size=4, max_size=60, unique_by=lambda x: x[1]),
       st.integers(2, 4))
def test_batch_equals_stream_property(spark, rows, cuts):
    """Rows in time order, cut into micro-batches: the stream's closed
    windows equal the batch roll-up."""
    base = ts("2023-01-01 00:00:00")
    msgs = sorted(((base + dt.timedelta(minutes=15 * k)), s, v / 4) for s, k, v in rows)
    topic = {"HVAC1": "IoT/energy/Airconditioning/HVAC1", "TH1": "IoT/temperature/TH1"}
    payloads = [(topic[s], f"{t:%Y-%m-%d %H:%M:%S} | {v}") for t, s, v in msgs]
    size = -(-len(payloads) // cuts)
    work = new_work_path(spark, "prop")
    _write_batches(spark, f"{work}/src", [payloads[i:i + size] for i in range(0, len(payloads), size)])
    stream = read_messages(spark, f"{work}/src", stream=True, max_files_per_trigger=1)
    out = run_available(gauge_daily(sensor_readings(stream), delay="1 second"), f"{work}/out")
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    closed = msgs[-1][0] - dt.timedelta(seconds=1)
    batch = gauge_daily(sensor_readings(read_messages(spark, f"{work}/src")))
    want = sorted(tuple(r) for r in batch.collect() if r.Day <= closed)
    assert got == want
