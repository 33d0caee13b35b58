from pyspark.sql import functions as F

from gridsense.sources.io import (append_dataset, read_dataset, read_messages, read_topic,
                                  write_messages, write_topic)
from tests.conftest import readings, ts


def test_text_messages_of_one_topic(spark, workdir):
    spark.createDataFrame([("2023-01-01 00:15:00 | 1.5",)], "value STRING").write.text(f"{workdir}/t")
    rows = read_messages(spark, f"{workdir}/t", fmt="text", topic="IoT/water/W1").collect()
    assert [tuple(r) for r in rows] == [("IoT/water/W1", "2023-01-01 00:15:00 | 1.5")]


def test_json_and_parquet_messages(spark, workdir):
    m = spark.createDataFrame([("IoT/water/W1", "2023-01-01 00:15:00 | 1.5")], "topic STRING, payload STRING")
    for fmt in ("json", "parquet"):
        write_messages(m, f"{workdir}/{fmt}", fmt=fmt)
        assert read_messages(spark, f"{workdir}/{fmt}", fmt=fmt).collect() == m.collect()


def test_topic_roundtrip(spark, workdir):
    df = readings(spark, [("2023-01-02 00:00:00", 4.5)]).select(F.col("DateTime").alias("Day"),
                                                                F.col("NumVal").alias("Total"))
    write_topic(df, f"{workdir}/topic")
    assert read_topic(spark, f"{workdir}/topic", "Day TIMESTAMP, Total DOUBLE").collect() == df.collect()


def test_dataset_by_sensors_and_inclusive_range(spark, workdir):
    r = readings(spark, [("2023-01-01 00:00:00", 1.0), ("2023-01-02 00:00:00", 2.0),
                         ("2023-01-03 00:00:00", 3.0)], "A") \
        .unionByName(readings(spark, [("2023-01-02 00:00:00", 9.0)], "B"))
    append_dataset(r, f"{workdir}/ds", sort_within=("DateTime",))
    got = read_dataset(spark, f"{workdir}/ds", sensor=["A"], start="2023-01-01 00:00:00",
                       end="2023-01-02 00:00:00")
    assert sorted((x.Sensor, x.DateTime, x.NumVal) for x in got.collect()) == [
        ("A", ts("2023-01-01 00:00:00"), 1.0), ("A", ts("2023-01-02 00:00:00"), 2.0)]
    assert read_dataset(spark, f"{workdir}/ds").count() == 4


def test_a_large_steady_partition_is_written_by_several_tasks(spark, workdir):
    """Steady readings have few compressed bytes, so Spark does not split them."""
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    rows = spark.range(200_000).select(F.lit("A").alias("Sensor"), F.timestamp_seconds("id").alias("DateTime"),
                                       F.lit(0.0).alias("NumVal"))
    was = spark.conf.get(least)
    spark.conf.set(least, "1k")  # small as the table is, its parts are not put together
    try:
        append_dataset(rows, f"{workdir}/ds", sort_within=("DateTime",))
    finally:
        spark.conf.set(least, was)
    got = read_dataset(spark, f"{workdir}/ds")
    assert got.columns == ["DateTime", "NumVal", "Sensor"]
    assert tuple(got.agg(F.count("*"), F.countDistinct("DateTime")).first()) == (200_000, 200_000)
    by_file = got.groupBy(F.input_file_name().alias("f")).count()
    assert by_file.agg(F.max("count")).first()[0] <= 100_000
