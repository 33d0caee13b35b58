"""Physical-plan properties the design relies on at scale."""

import pytest

from gridsense.plans.queries import QUERIES
from gridsense.operators.counter import counter_daily_diff
from gridsense.operators.leak import latest_per_key
from gridsense.operators.rollup import daily_rollup
from gridsense.plans import jobs
from gridsense.sources import events as ev
from gridsense.sources.io import read_dataset
from tests.conftest import SF001, readings


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyed_rollup_is_partial_hash_aggregate(spark):
    p = plan(daily_rollup(readings(spark, [("2023-01-01 01:00:00", 1.0)], "A"),
                          how=["sum", "avg"], by="Sensor"))
    assert "partial_sum" in p and "partial_avg" in p
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_counter_difference_is_partial_aggregate(spark):
    p = plan(counter_daily_diff(readings(spark, [("2023-01-01 00:00:00", 1.0)], "A"), by="Sensor"))
    assert p.count("partial_min") >= 2 and "Window" not in p


def test_latest_per_key_no_sort_no_window(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "Day INT, batch_id LONG, v DOUBLE")
    p = plan(latest_per_key(df, "Day", "batch_id"))
    assert "partial_max_by" in p and "SortAggregate" not in p and "Window" not in p


def test_messages_parsed_once(spark, workdir):
    """No filter on parsed columns is pushed below the parsing: validity is
    kept by a Generate and roll-ups need no filter at all."""
    from gridsense.sources.io import read_messages, write_messages
    write_messages(ev.event_messages(spark, SF001), f"{workdir}/m")
    m = read_messages(spark, f"{workdir}/m")
    for df in (jobs.ingest_raw(m), jobs.sensor_readings(m),
               jobs.gauge_daily(jobs.sensor_readings(m))):
        p = plan(df)
        filters = [ln for ln in p.splitlines() if "Filter" in ln]
        assert not any("substring_index" in ln for ln in filters), p
    assert "Generate explode" in plan(jobs.ingest_raw(m))


def test_dataset_read_prunes_partitions_and_pushes_range(spark, workdir):
    env = jobs.ingest_raw(ev.event_messages(spark, SF001), sensors=ev.EVENT_SENSORS)
    jobs.store_raw(env, f"{workdir}/raw")
    df = read_dataset(spark, f"{workdir}/raw", sensor="click", start="2024-02-03", end="2024-02-04")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Sensor" in p and "(Sensor#" in p
    assert "(month#" in p and ">= 2024-02-01)" in p and "<= 2024-02-01)" in p  # month folders pruned
    assert df.count() == 0  # no folder of February: nothing read
    assert "GreaterThanOrEqual(DateTime" in p and "LessThanOrEqual(DateTime" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(QUERIES["daily_sum"](spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in p


BATCH = [n for n in QUERIES if not n.startswith("stream_")]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_udf_and_no_forced_broadcast(spark, name):
    df = QUERIES[name](spark, SF001)
    qe = df._jdf.queryExecution()
    p = qe.executedPlan().toString()
    assert "EvalPython" not in p and "PythonUDF" not in p
    assert "broadcast" not in qe.logical().toString().lower()
