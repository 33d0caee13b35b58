"""The clustered layout, the log of progress, the SQL functions."""

import re

import pytest
from pyspark.sql import functions as F

from gridsense.functions.sql import register
from gridsense.operators.counter import counter_daily_diff
from gridsense.plans.jobs import store_raw
from gridsense.sources.io import append_clustered, read_dataset
from gridsense.streaming.progress import ProgressLog
from gridsense.streaming.sinks import start_topic_sink, wait_for
from tests.conftest import readings, ts


def _rows_read(df):
    """Rows that the scan gave after skipping row groups and pages."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan"):
            found.append(node.metrics().apply("numOutputRows").value())
        if name == "AdaptiveSparkPlan":
            walk(node.executedPlan())
            return
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(plan)
    return sum(found)


def _many_sensors(spark, sensors=10_000, days=30):
    return spark.range(sensors * days).select(
        F.format_string("s%05d", F.col("id") % sensors).alias("Sensor"),
        (F.lit("2023-01-01").cast("timestamp") + F.make_dt_interval(days=(F.col("id") / sensors).cast("int"),
                                                                    hours=F.lit(7))).alias("DateTime"),
        F.col("id").cast("double").alias("value"), F.lit("energy").alias("domain"))


def test_one_of_ten_thousand_sensors_reads_few_rows(spark, workdir):
    path = f"{workdir}/raw"
    append_clustered(_many_sensors(spark), path, row_group_bytes=1 << 18)
    df = read_dataset(spark, path, sensor="s04321", start="2023-01-05 00:00:00", end="2023-01-06 23:59:59")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan)[1]
    assert "EqualTo(Sensor,s04321)" in pushed and "GreaterThanOrEqual(DateTime" in pushed
    assert [(r["Sensor"], r["value"]) for r in df.orderBy("value").collect()] == [("s04321", 44321.0), ("s04321", 54321.0)]
    assert _rows_read(df) < 0.05 * 300_000  # of all rows
    assert _rows_read(read_dataset(spark, path, sensor="nobody")) <= 0.05 * 300_000


def test_clustered_raw_store_equals_the_foldered_one(spark, workdir):
    env = _many_sensors(spark, 40, 70)
    store_raw(env, f"{workdir}/a")
    store_raw(env, f"{workdir}/b", clustered=True)
    for args in ({"sensor": "s00007"}, {"sensor": ["s00001", "s00039"], "start": "2023-01-30 00:00:00",
                                        "end": "2023-02-03 00:00:00"}, {}):
        a, b = (sorted(map(tuple, read_dataset(spark, f"{workdir}/{x}", **args)
                           .select("Sensor", "DateTime", "value", "domain").collect())) for x in "ab")
        assert a == b and a


def test_progress_is_kept_batch_by_batch(spark, workdir):
    for day in (13, 11, 3, 14):  # lateness is judged by the watermark of the batch before
        readings(spark, [(f"2023-01-{day:02d} 12:00:00", 1.0)]).coalesce(1).write.mode("append").parquet(f"{workdir}/src")
    log = ProgressLog(spark, f"{workdir}/log", every=2)
    df = spark.readStream.schema("DateTime TIMESTAMP, NumVal DOUBLE").option("maxFilesPerTrigger", 1).parquet(f"{workdir}/src")
    sums = df.withWatermark("DateTime", "3 days").groupBy(F.window("DateTime", "1 day")).agg(F.sum("NumVal").alias("s"))
    q = start_topic_sink(sums.select("window.end", "s"), f"{workdir}/out", mode="update", query_name="kept",
                         trigger={"availableNow": True})
    wait_for([q])
    rows = log.close([q])
    own = rows.where(F.col("run_id") == str(q.runId))
    total = own.agg(F.sum("input_rows"), F.sum("dropped_by_watermark"), F.max("state_rows")).first()
    assert tuple(total) == (4, 1, 3)  # the ten-days-late row is counted
    assert {r[0] for r in own.select("query").distinct().collect()} == {"kept"}
    assert own.select("batch").distinct().count() >= 4


def test_counter_difference_by_name_in_sql(spark):
    rows = readings(spark, [("2023-01-01 00:00:00", 110.5), ("2023-01-02 00:00:00", 215.25), ("2023-01-02 08:00:00", 300.0),
                            ("2023-01-03 00:00:00", 330.0), ("2023-01-05 00:00:00", 400.0), ("2023-01-04 00:00:00", None)], "Wtot")
    rows = rows.unionByName(readings(spark, [("2023-01-02 00:00:00", 1.0), ("2023-01-03 00:00:00", 3.5)], "Etot"))
    register(rows)
    want = counter_daily_diff(rows, by="Sensor")
    assert sorted(map(tuple, spark.sql("SELECT * FROM counter_diff(NULL)").collect())) == sorted(map(tuple, want.collect()))
    one = spark.sql("SELECT Day, daily_diff FROM counter_diff('Etot')").collect()
    assert [tuple(r) for r in one] == [(ts("2023-01-03 00:00:00"), 2.5)]
    got = spark.sql("SELECT Sensor, val_diff(collect_list(struct(DateTime AS t, NumVal AS v))) AS d "
                    "FROM gridsense_readings GROUP BY Sensor ORDER BY Sensor").collect()
    assert [tuple(r) for r in got] == [("Etot", 2.5), ("Wtot", pytest.approx(289.5))]
