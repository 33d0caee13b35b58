"""Domain jobs on a household fixture shaped like the simulator's output,
checked against brute force in plain Python."""

import datetime as dt
from collections import defaultdict

import pytest

from gridsense import registry
from gridsense.functions.parse import encode_json, raw_envelope
from gridsense.plans import jobs
from gridsense.sources.io import read_dataset, read_messages, read_topic
from gridsense.streaming.sinks import run_available

START = dt.datetime(2023, 1, 1)
STEP = dt.timedelta(minutes=15)
DAYS = 4
FMT = "%Y-%m-%d %H:%M:%S"
TOPIC = {s.name: s.topic for s in registry.HOUSEHOLD}


def _fixture(days=DAYS):
    """(topic, payload) rows: one reading per gauge per 15 minutes, counters
    at midnight, a W1 row 2 days late every 20 steps and a flagged W1 row 10
    days late every 120 steps (the simulator's cadence)."""
    rows, etot, wtot = [], 0.0, 0.0
    for k in range(days * 96):
        t = START + k * STEP
        s = t.strftime(FMT)
        if k % 96 == 0:
            etot = round(etot + 62400.0 + (k // 96) * 10, 2)
            wtot = round(wtot + 110.0 + (k // 96), 2)
            rows += [(TOPIC["Etot"], f"{s} | {etot}"), (TOPIC["Wtot"], f"{s} | {wtot}")]
        if k % 20 == 0 and k:
            rows.append((TOPIC["W1"], f"{(t - dt.timedelta(days=2)).strftime(FMT)} | 0.25"))
        if k % 120 == 0 and k:
            rows.append((TOPIC["W1"], f"{(t - dt.timedelta(days=10)).strftime(FMT)} | 0.44f"))
        rows += [(TOPIC["HVAC1"], f"{s} | {1.0 + k % 3}"), (TOPIC["MiAC2"], f"{s} | 2.5"),
                 (TOPIC["TH1"], f"{s} | {20.0 + k % 2}"), (TOPIC["TH2"], f"{s} | 15.5"),
                 (TOPIC["Mov1"], f"{s} | {1 if k % 96 in (3, 20, 40, 60, 80) else 0}"),
                 (TOPIC["W1"], f"{s} | 0.5")]
    return rows


def _parse(rows):
    out = []
    for topic, payload in rows:
        ts, val = payload.split(" | ")
        out.append((topic.split("/")[-1], dt.datetime.strptime(ts, FMT), val))
    return out


def _day_end(t):
    return dt.datetime(t.year, t.month, t.day) + dt.timedelta(days=1)


@pytest.fixture(scope="module")
def msgs(spark):
    return spark.createDataFrame(_fixture(), "topic STRING, payload STRING")


def test_energy_job_matches_brute_force(spark, msgs):
    out = jobs.energy_job(msgs, counter_lt=72000.0)
    sums = defaultdict(float)
    for sensor, t, v in _parse(_fixture()):
        if sensor in ("HVAC1", "MiAC2"):
            sums[(sensor, _day_end(t))] += float(v)
    got = {(r.Sensor, r.Day): r.Total for r in out["daily"].collect()}
    assert got == {k: round(v, 2) for k, v in sums.items()}
    # Etot as the reference emits it: first single reading shown, last hidden.
    readings = sorted((t, float(v)) for s, t, v in _parse(_fixture()) if s == "Etot")
    want = [(readings[0][0].date(), readings[0][1])]
    want += [(b[0].date(), b[1] - a[1]) for a, b in zip(readings, readings[1:])]
    got = sorted((r.Day, r.daily_diff) for r in out["counter_diff"].collect())
    assert got == want


def test_temp_job_average_and_movement_count(spark, msgs):
    got = {(r.Sensor, r.Day): r.Total for r in jobs.temp_job(msgs)["daily"].collect()}
    for d in range(1, DAYS + 1):
        day = dt.datetime(2023, 1, d + 1)
        assert got[("TH1", day)] == 20.5 and got[("TH2", day)] == 15.5
        assert got[("Mov1", day)] == 5.0


def test_water_job_late_rows_and_bounds(spark, msgs):
    out = jobs.water_job(msgs, sub_gt=40.0, counter_lt=150.0)
    acc, rej = defaultdict(float), defaultdict(float)
    for sensor, t, v in _parse(_fixture()):
        if sensor != "W1":
            continue
        if "f" in v:
            end = t.replace(minute=t.minute - t.minute % 10, second=0) + dt.timedelta(minutes=10)
            rej[end] += float(v.replace("f", ""))
        else:
            acc[_day_end(t)] += float(v)
    got = {r.Day: r.Totalw1 for r in out["accepted_daily"].collect()}
    assert got == {d: round(v, 2) for d, v in acc.items() if round(v, 2) > 40}
    assert {r.RejectedEvent: r.RejectedVal for r in out["rejected"].collect()} == dict(rej)
    diffs = sorted((r.Day, r.daily_diff) for r in out["counter_diff"].collect())
    assert [d for _, d in diffs] == [110.0, 111.0, 112.0, 113.0]  # first reading, then pairs


def test_batch_leak_of_water_job(spark, msgs):
    w = jobs.water_job(msgs, sub_gt=40.0)
    leak = {r.Day: r.LeakValue for r in jobs.leak_job(w["accepted_daily"], w["counter_diff"]).collect()}
    acc = {r.Day: r.Totalw1 for r in w["accepted_daily"].collect()}
    dif = {r.Day: r.daily_diff for r in w["counter_diff"].collect()}
    assert leak == {d: round(dif[d] - acc[d], 2) for d in acc.keys() & dif.keys()}
    assert len(leak) == DAYS - 1


def test_stream_raw_ingest_by_domain_then_panels(spark, workdir):
    src = f"{workdir}/src"
    spark.createDataFrame(_fixture(), "topic STRING, payload STRING").write.parquet(src)
    env = jobs.ingest_raw(read_messages(spark, src, stream=True))
    run_available(env, f"{workdir}/store/raw", partition_by=["domain", "Sensor"])
    domains = {r.domain for r in spark.read.parquet(f"{workdir}/store/raw").select("domain").distinct().collect()}
    assert domains == {"energy", "water", "temp"}
    th1 = jobs.panel(spark, f"{workdir}/store", "th1_raw", start="2023-01-02 00:00:00",
                     end="2023-01-02 23:59:59")
    assert th1.count() == 96
    w1 = jobs.panel(spark, f"{workdir}/store", "w1_raw")
    flagged = sum(1 for s, _, v in _parse(_fixture()) if s == "W1" and "f" in v)
    assert w1.count() == sum(1 for s, _, _ in _parse(_fixture()) if s == "W1") - flagged
    jobs.store_daily(jobs.temp_job(spark.read.parquet(src))["daily"], f"{workdir}/store/daily")
    th2 = jobs.panel(spark, f"{workdir}/store", "th2_daily_avg")
    assert {r.Total for r in th2.collect()} == {15.5}


def test_sensor_names_of_digits_stay_text(spark, workdir):
    rows = [("IoT/water/007", "2023-01-01 00:00:00 | 1.5"), ("IoT/water/010", "2023-01-01 00:00:00 | 2.5")]
    env = jobs.ingest_raw(spark.createDataFrame(rows, "topic STRING, payload STRING"))
    jobs.store_raw(env, f"{workdir}/raw")
    df = read_dataset(spark, f"{workdir}/raw")
    assert sorted((r.Sensor, r.value) for r in df.collect()) == [("007", 1.5), ("010", 2.5)]
    assert read_dataset(spark, f"{workdir}/raw", sensor="007").count() == 1


def test_partitioned_write_makes_few_files(spark, workdir):
    rows = [(f"IoT/water/s{k % 6}", f"2023-01-01 00:00:{k % 60:02d} | {k}") for k in range(960)]
    msgs = spark.createDataFrame(rows, "topic STRING, payload STRING").repartition(16)
    jobs.store_raw(jobs.ingest_raw(msgs), f"{workdir}/raw")
    assert len(spark.read.parquet(f"{workdir}/raw").inputFiles()) <= 12  # 6 partitions


def test_topic_filter_reaches_the_scan(spark, workdir):
    src = f"{workdir}/src"
    spark.createDataFrame(_fixture(1), "topic STRING, payload STRING").write.parquet(src)
    out = jobs.temp_job(spark.read.parquet(src))["daily"]
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(topic, [" in p or "In(topic, [" in p.split("PushedFilters")[1]


def test_work_folder_is_asked_for_on_a_cluster(spark):
    from types import SimpleNamespace
    from gridsense.session import work_dir
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None),
                           sparkContext=SimpleNamespace(master="spark://h:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(bare)


def test_reference_record_shape(spark, msgs):
    daily = jobs.energy_job(msgs, counter_lt=None)["daily"]
    rec = jobs.as_reference_record(daily, "HVAC1")
    assert rec.columns == ["Day", "TotalHVAC1"] and rec.count() == DAYS


def test_app_catch_up_run(spark, workdir):
    from gridsense.app import main
    src = f"{workdir}/msgs"
    spark.createDataFrame(_fixture(days=8), "topic STRING, payload STRING").write.parquet(src)
    w = jobs.water_job(spark.read.parquet(src), sub_gt=None)
    batch = {r.Day: r.LeakValue for r in jobs.leak_job(w["accepted_daily"], w["counter_diff"]).collect()}
    rows = []
    for _ in range(2):  # repeated catch-up runs store nothing twice
        main(["--messages", src, "--root", f"{workdir}/topics", "--store", f"{workdir}/store", "--once"])
        leak = jobs.panel(spark, f"{workdir}/store", "water_leak").collect()
        assert {r.Day: r.LeakValue for r in leak} == batch and {r.Meter for r in leak} == {"Wtot"}
        rows.append({name: jobs.panel(spark, f"{workdir}/store", name).count() for name in jobs.PANELS})
    assert rows[0] == rows[1] and all(rows[0].values())


def test_raw_topics_per_domain(spark, workdir):
    src = f"{workdir}/src"
    spark.createDataFrame(_fixture(), "topic STRING, payload STRING").write.parquet(src)
    env = raw_envelope(read_messages(spark, src, stream=True))
    run_available(env, f"{workdir}/raw", fmt="json", partition_by=["domain"],
                  json_cols=["Sensor", "DateTime", "value"])
    recs = read_topic(spark, f"{workdir}/raw", "Sensor STRING, DateTime STRING, value DOUBLE",
                      keep=["domain"])
    got = {(r.domain, r.Sensor) for r in recs.select("domain", "Sensor").distinct().collect()}
    assert got == {("energy", "HVAC1"), ("energy", "MiAC2"), ("energy", "Etot"), ("water", "W1"),
                   ("water", "Wtot"), ("temp", "TH1"), ("temp", "TH2"), ("temp", "Mov1")}
    text = spark.read.text(f"{workdir}/raw/domain=water").first().value
    assert text.startswith('{"Sensor":') and '"DateTime":"2023-' in text


def test_kafka_topics_take_the_connector_path(spark, workdir):
    """No Kafka connector here: the query must fail looking for it, which
    shows the topics are routed to Kafka with their names as options."""
    src = f"{workdir}/src"
    spark.createDataFrame(_fixture(days=1), "topic STRING, payload STRING").write.parquet(src)
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.start_household(read_messages(spark, src, stream=True), f"{workdir}/ck",
                             kafka={"kafka.bootstrap.servers": "localhost:9092"})
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.start_leak(spark, f"{workdir}/ck", kafka={"kafka.bootstrap.servers": "localhost:9092"})


def test_envelope_topic_feeds_the_rollups(spark, msgs):
    records = encode_json(raw_envelope(msgs), ["Sensor", "DateTime", "value"])
    daily = jobs.gauge_daily(jobs.envelope_readings(records).where("Sensor = 'HVAC1'"))
    direct = jobs.gauge_daily(jobs.sensor_readings(msgs, ["HVAC1"]))
    assert sorted(daily.collect()) == sorted(direct.collect())


def test_app_rejects_inconsistent_arguments():
    from gridsense.app import main
    with pytest.raises(SystemExit):
        main(["--root", "/nonexistent/topics"])  # no message folder and not Kafka
    with pytest.raises(SystemExit):
        main(["--fmt", "kafka", "--root", "/nonexistent/topics", "--store", "/x",
              "--kafka", "kafka.bootstrap.servers=localhost:9092"])
