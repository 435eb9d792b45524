import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import bag, rows, utc
from pedalflow import sources
from pedalflow.operators import decode_messages, encode_messages
from pedalflow.plans import queries as q
from pedalflow.plans.analytics import station_snapshot
from pedalflow.schemas import MESSAGE, STATION_INFO, USAGE_SUMMARY
from pedalflow.session import build_session, fresh_path, shared_folder, state_partitions, stored
from pedalflow.sources.channels import kafka_read_options


def test_kafka_options():
    channel = sources.kafka_channel("station_status", **{"maxOffsetsPerTrigger": "1000"})
    assert kafka_read_options(channel, streaming=True) == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "station_status",
        "maxOffsetsPerTrigger": "1000",
        "failOnDataLoss": "false",
    }
    batch = sources.kafka_channel("station_info", "broker:1", failOnDataLoss="true")
    assert kafka_read_options(batch, streaming=False)["failOnDataLoss"] == "true"


def test_kafka_needs_the_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        sources.read_messages(spark, sources.kafka_channel("station_info"))


def test_file_channel_roundtrip(spark, scratch):
    channel = sources.file_channel(f"{scratch}/info")
    stations = spark.createDataFrame([("1", "a", 1.0, 2.0, 3), ("2", None, None, None, 0)], STATION_INFO)
    sources.write_messages(encode_messages(stations, "station_id"), channel)
    back = sources.read_messages(spark, channel)
    assert back.schema == MESSAGE
    assert bag(decode_messages(back, STATION_INFO)) == bag(stations)


def test_a_second_publication_wins(spark, scratch):
    channel = sources.file_channel(f"{scratch}/info")
    first = spark.createDataFrame([("1", "old", 1.0, 2.0, 3), ("2", "b", 1.0, 2.0, 4)], STATION_INFO)
    sources.write_messages(encode_messages(first, "station_id"), channel)
    time.sleep(0.01)
    second = first.where("station_id = '1'").withColumn("name", F.lit("new"))
    sources.write_messages(encode_messages(second, "station_id"), channel)
    snapshot = station_snapshot(sources.read_messages(spark, channel))
    assert rows(snapshot, "station_id", "name") == [("1", "new"), ("2", "b")]


def test_documents_as_files_and_lines(spark, scratch):
    for name, text in {"a": '{"x":\n1}', "b": '{"x":2}\n{"x":3}'}.items():
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    assert sources.read_documents(spark, scratch).count() == 2
    lines = sources.read_documents(spark, f"{scratch}/b", whole=False)
    assert rows(lines, "value") == [('{"x":2}',), ('{"x":3}',)]
    assert lines.where("landed_at IS NULL").isEmpty()


def summary_frame(spark, n=3):
    return spark.range(n).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("window_start"),
        F.timestamp_seconds(F.lit(1704069000) + F.col("id") * 1800).alias("window_end"),
        F.lit("Dubai, Marina").alias("city"),
        (F.col("id") / 3).alias("avg_util"),
        F.lit(1.0).alias("max_util"),
        F.lit(0.0).alias("min_util"),
        F.when(F.col("id") > 0, 0.1).alias("std_util"),
        *[F.lit(2.5).alias(c) for c in ("avg_temp", "avg_wind", "avg_clouds", "avg_rain")],
    )


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_summary_dataset(spark, scratch, fmt):
    half_hours, minutes = summary_frame(spark, 5), summary_frame(spark, 7)
    sources.write_summary(half_hours, scratch, fmt, "30 minutes", 0)
    sources.write_summary(minutes, scratch, fmt, "1 minute", 0)
    back = sources.read_summary(spark, scratch, fmt, "30 minutes")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in USAGE_SUMMARY]
    assert back.collect() != [] and bag(back) == bag(half_hours)
    assert sources.read_summary(spark, scratch, fmt, "1 minute").count() == 7
    with pytest.raises(ValueError, match="several window lengths"):
        sources.read_summary(spark, scratch, fmt)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grain" in plan


def test_a_batch_written_twice_counts_once(spark, scratch):
    for _ in range(2):
        sources.write_summary(summary_frame(spark), scratch, "parquet", "30 minutes", 4)
    sources.write_summary(summary_frame(spark, 2), scratch, "parquet", "30 minutes", 5)
    assert sources.read_summary(spark, scratch, grain="30 minutes").count() == 5


def test_plain_csv_file(spark, scratch):
    """A single file with a header, zone-less times and empty cells."""
    header = ",".join(USAGE_SUMMARY.names)
    lines = [
        header,
        "2024-01-01 00:00:00,2024-01-01 00:30:00,Dubai,0.5,0.5,0.5,,21.5,3.0,40.0,0.0",
        "2024-01-01 00:30:00,2024-01-01 01:00:00,Dubai,0.25,0.5,0.0,0.35,21.5,3.0,40.0,0.0",
    ]
    path = os.path.join(scratch, "usage_summary.csv")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    got = rows(sources.read_summary(spark, path, "csv"), "window_start", "city", "avg_util", "std_util", "avg_clouds")
    assert got == [
        (utc("2024-01-01 00:00"), "Dubai", 0.5, None, 40.0),
        (utc("2024-01-01 00:30"), "Dubai", 0.25, 0.35, 40.0),
    ]


def test_stored_tables_go_to_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    table = stored(spark.range(10), "numbers")
    assert shared_folder(spark) in table.inputFiles()[0] and table.count() == 10


def test_state_partitions_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with state_partitions(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_session_settings(spark):
    session = build_session(spark__sql__sources__parallelPartitionDiscovery__threshold=32)
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_queries_take_any_zone(spark, small):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert q.QUERIES["usage_summary_30m"](spark, small).count() == 28
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
