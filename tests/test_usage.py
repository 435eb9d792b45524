import statistics

import pytest
from pyspark.sql import functions as F

from helpers import bag, epoch, rows, utc
from pedalflow import operators as op
from pedalflow.plans.analytics import station_snapshot


def status(spark, data):
    """Status rows of (time, city, bikes, docks)."""
    frame = spark.createDataFrame(data, "t string, city string, num_bikes_available int, num_docks_available int")
    return frame.withColumn("event_time", F.col("t").cast("timestamp")).drop("t")


def test_utilization_without_places_is_null(spark):
    frame = status(spark, [("2024-01-01 00:00:00", "a", 0, 0), ("2024-01-01 00:00:00", "a", 1, 3)])
    assert rows(op.with_utilization(frame), "utilization") == [(None,), (0.25,)]


def test_utilization_of_extreme_counts(spark):
    frame = status(spark, [("2024-01-01 00:00:00", "a", 2147483647, 2147483647)])
    assert rows(op.with_utilization(frame), "utilization") == [(0.5,)]


def test_event_time_keeps_the_repeated_hour(spark):
    frame = spark.createDataFrame([(1699162200,), (1699165800,)], "event_timestamp long")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        seconds = op.with_event_time(frame).select(F.col("event_time").cast("long"))
        assert rows(seconds) == [(1699162200,), (1699165800,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_event_time_of_absurd_numbers(spark):
    frame = spark.createDataFrame([(None,), (2**62,), (-(2**62),), (99999999999,)], "event_timestamp long")
    assert [r[0] for r in rows(op.with_event_time(frame).select(F.col("event_time").cast("long")))] == [
        None,
        None,
        None,
        99999999999,
    ]


def test_windows_and_measures(spark):
    data = [
        ("2024-01-01 00:00:00", "a", 1, 3),
        ("2024-01-01 00:29:59", "a", 3, 1),
        ("2024-01-01 00:30:00", "a", 1, 1),
        ("2024-01-01 00:10:00", "a", 0, 0),
        ("2024-01-01 00:10:00", "b", 0, 0),
        (None, "a", 5, 0),
    ]
    result = op.flat_window(op.utilization_by_window(status(spark, data)))
    a = utc("2024-01-01 00:00"), utc("2024-01-01 00:30"), utc("2024-01-01 01:00")
    deviation = round(statistics.stdev([0.25, 0.75]), 6)
    assert bag(result) == {
        (a[0], a[1], "a", 0.5, 0.75, 0.25, deviation): 1,
        (a[1], a[2], "a", 0.5, 0.5, 0.5, None): 1,
        (a[0], a[1], "b", None, None, None, None): 1,
    }


def test_summary_needs_both_sides(spark):
    util = op.utilization_by_window(
        status(spark, [("2024-01-01 00:00:00", "a", 1, 1), ("2024-01-01 00:30:00", "a", 1, 1)]), "30 minutes"
    )
    air = spark.createDataFrame(
        [("2024-01-01 00:05:00", "a", 10.0, 1.0, 20, 0.0), ("2024-01-01 00:05:00", "b", 10.0, 1.0, 20, 0.0)],
        "t string, city string, temperature double, wind_speed double, cloudiness int, precipitation double",
    ).withColumn("event_time", F.col("t").cast("timestamp"))
    summary = op.usage_summary(util, op.weather_by_window(air, "30 minutes"))
    assert rows(summary, "window_start", "city", "avg_util", "avg_clouds") == [
        (utc("2024-01-01 00:00"), "a", 0.5, 20.0)
    ]


def test_other_keys_and_grain(spark):
    frame = status(spark, [("2024-01-01 00:00:10", "a", 1, 1), ("2024-01-01 00:00:50", "a", 1, 3)])
    frame = frame.withColumn("zone", F.lit(1))
    windows = op.flat_window(op.utilization_by_window(frame, "1 minute", keys=("city", "zone")))
    assert rows(windows, "city", "zone", "avg_util") == [("a", 1, 0.375)]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_layout_does_not_matter(spark, parts):
    spread = spark.range(0, 3000, 1, parts).select(
        F.timestamp_seconds(F.lit(epoch("2024-01-01 00:00")) + F.col("id") * 37).alias("event_time"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7)).alias("city"),
        (F.col("id") % 11).cast("int").alias("num_bikes_available"),
        (F.col("id") % 5).cast("int").alias("num_docks_available"),
    )
    expected = op.flat_window(op.utilization_by_window(spread.coalesce(1)))
    assert bag(op.flat_window(op.utilization_by_window(spread))) == bag(expected)


def test_latest_record_per_station(spark):
    data = [("1", 1, "old"), ("1", 3, "new"), ("1", 2, "mid"), ("2", 1, None)]
    frame = spark.createDataFrame(data, "station_id string, offset long, name string")
    latest = op.latest_by_key(frame, "station_id", "offset")
    assert latest.columns == frame.columns
    assert rows(latest) == [("1", 3, "new"), ("2", 1, None)]


def test_latest_record_of_a_very_common_key(spark):
    frame = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("station_id"), F.col("id").alias("offset")
    )
    latest = op.latest_by_key(frame, "station_id", "offset")
    assert latest.count() == frame.select("station_id").distinct().count()
    assert latest.where("station_id = 0").first().offset == 19998


def test_snapshot_drops_invalid_before_taking_the_latest(spark):
    texts = [
        ('{"station_id":"1","name":"a","lat":1,"lon":2,"capacity":5}', 1),
        ('{"station_id":"1","name":"b","lat":1,"lon":2}', 2),
        ("broken", 3),
    ]
    frame = spark.createDataFrame(texts, "value string, offset long")
    frame = frame.withColumns({"value": F.col("value").cast("binary"), "timestamp": F.timestamp_seconds(F.lit(0))})
    assert rows(station_snapshot(frame)) == [("1", "a", 1.0, 2.0, 5)]


def test_enriched_status_keeps_rows_and_counts(spark):
    facts = spark.createDataFrame([("1", 5), ("1", 6), ("9", 7), (None, 8)], "station_id string, n int")
    stations = spark.createDataFrame([("1", "a", 1), ("1", "b", 2)], "station_id string, name string, offset int")
    stations = op.latest_by_key(stations, "station_id", "offset").drop("offset")
    expected = [(None, 8, None), ("1", 5, "b"), ("1", 6, "b"), ("9", 7, None)]
    assert rows(op.enrich_status(facts, stations), "station_id", "n", "name") == expected
