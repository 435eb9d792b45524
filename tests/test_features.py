from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import bag, rows, times, utc
from pedalflow import operators as op
from pedalflow.operators.leads import LEADS

WEATHER = {"avg_temp": 20.0, "avg_wind": 1.0, "avg_rain": 0.0, "avg_clouds": 5.0}


def led(frame):
    return {r.window_start: r.time_t1h for r in frame.collect()}


def test_leads_over_a_gap(spark):
    texts = ["2024-01-01 00:00", "2024-01-01 00:30", "2024-01-01 01:30", "2024-01-01 02:00"]
    at = [utc(t) for t in texts]
    summary = times(spark, texts, city="a", **WEATHER)
    assert led(op.lead_by_rows(summary)) == {at[0]: at[2], at[1]: at[3], at[2]: None, at[3]: None}
    assert led(op.lead_by_time(summary)) == {at[0]: None, at[1]: at[2], at[2]: None, at[3]: None}


def test_leads_stay_in_their_city(spark):
    even = times(spark, ["2024-01-01 00:00", "2024-01-01 01:00", "2024-01-01 02:00"], city="a", **WEATHER)
    odd = times(spark, ["2024-01-01 00:30", "2024-01-01 01:30", "2024-01-01 02:30"], city="b", **WEATHER)
    both = even.union(odd)
    by_rows = rows(op.lead_by_rows(both).where("time_t1h IS NOT NULL"), "city", "window_start", "time_t1h")
    assert by_rows == [
        ("a", utc("2024-01-01 00:00"), utc("2024-01-01 02:00")),
        ("b", utc("2024-01-01 00:30"), utc("2024-01-01 02:30")),
    ]
    assert op.lead_by_time(both).where("time_t1h IS NOT NULL").count() == 4


def test_leads_carry_all_values(spark):
    texts = ["2024-01-01 00:00", "2024-01-01 00:30", "2024-01-01 01:00"]
    summary = times(spark, texts, city="a", **WEATHER).withColumn("avg_temp", F.col("avg_util") * 10)
    for result in (op.lead_by_rows(summary), op.lead_by_time(summary)):
        assert result.columns == [*summary.columns, *LEADS.values()]
        first = result.orderBy("window_start").first()
        assert (first.temp_t1h, first.wind_t1h, first.rain_t1h, first.clouds_t1h) == (20.0, 1.0, 0.0, 5.0)
        assert (first.util_t1h, first.time_t1h) == (2.0, utc("2024-01-01 01:00"))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    slots=st.lists(
        st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 4000)), min_size=1, max_size=60, unique=True
    ),
    n=st.integers(1, 5),
    chunk=st.sampled_from(["week", "month"]),
)
def test_chunks_do_not_show(spark, slots, n, chunk):
    """Row leads by chunk equal a plain count along the timeline, also with sparse and null cities."""
    start = utc("2024-01-01 00:00")
    data = [(city, start + timedelta(minutes=30 * slot), float(slot)) for city, slot in slots]
    frame = spark.createDataFrame(data, "city string, window_start timestamp, avg_util double")
    result = op.lead_by_rows(frame, n, {"avg_util": "later", "window_start": "at"}, chunk=chunk)
    expected = {}
    for city, slot in slots:
        line = sorted(s for c, s in slots if c == city)
        place = line.index(slot) + n
        later = float(line[place]) if place < len(line) else None
        at = None if later is None else start + timedelta(minutes=30 * later)
        expected[(city, start + timedelta(minutes=30 * slot), float(slot), later, at)] = 1
    assert bag(result) == expected


def test_both_leads_agree_without_gaps(spark):
    frame = spark.range(0, 1500).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("window_start"),
        F.lit("a").alias("city"),
        F.col("id").cast("double").alias("avg_util"),
        *[F.lit(v).alias(k) for k, v in WEATHER.items()],
    )
    assert bag(op.lead_by_rows(frame)) == bag(op.lead_by_time(frame))


def test_day_flags(spark):
    frame = times(spark, ["2024-01-06 23:30", "2024-01-07 00:00", "2024-01-08 13:00"], city="a")
    got = op.calendar_features(frame, "window_start").select("window_start", "hour_t1h", "dow_t1h", "is_weekend_t1h")
    assert rows(got) == [
        (utc("2024-01-06 23:30"), 23, 7, 1.0),
        (utc("2024-01-07 00:00"), 0, 1, 1.0),
        (utc("2024-01-08 13:00"), 13, 2, 0.0),
    ]


def test_calendar_in_another_zone(spark):
    frame = times(spark, ["2024-01-05 21:00"], city="a")
    assert rows(op.calendar_features(frame, "window_start", "Asia/Dubai"), "hour_t1h", "dow_t1h") == [(1, 7)]


def test_incomplete_rows_are_dropped(spark):
    texts = ["2024-01-01 00:00", "2024-01-01 00:30", "2024-01-01 01:00", "2024-01-01 01:30"]
    summary = times(spark, texts, city="a", **WEATHER)
    holes = summary.withColumn("avg_clouds", F.when(F.col("avg_util") != 2, F.col("avg_clouds")))
    assert op.feature_rows(summary).count() == 2
    assert rows(op.feature_rows(holes), "window_start") == [(utc("2024-01-01 00:30"),)]
    unlabeled = summary.withColumn("avg_util", F.when(F.col("avg_util") != 2, F.col("avg_util")))
    assert op.feature_rows(unlabeled).count() == 1
    assert op.feature_rows(unlabeled, labeled=False).count() == 2
    assert op.feature_rows(summary, rows=2).count() == 2


def test_split_is_stable(spark):
    frame = spark.range(0, 5000).select(
        F.timestamp_seconds(F.col("id") * 1800).alias("window_start"), F.lit("a").alias("city")
    )
    one, many = op.split(frame.coalesce(1)), op.split(frame.repartition(13))
    assert bag(one) == bag(many)
    counts = {r.part: r.n for r in op.split_counts(one).collect()}
    assert sum(counts.values()) == 5000 and 3800 < counts["train"] < 4200


def test_split_by_time(spark):
    frame = times(spark, ["2024-01-01 00:00", "2024-01-02 00:00", "2024-01-03 00:00"], city="a")
    parts = op.split(frame, "2024-01-02 00:00:00")
    assert rows(parts, "avg_util", "part") == [(0.0, "train"), (1.0, "test"), (2.0, "test")]
    by_column = op.split(frame, frame.agg(F.max("window_start")).scalar())
    assert [r[1] for r in rows(by_column, "avg_util", "part")] == ["train", "train", "test"]


def test_histogram(spark):
    frame = spark.createDataFrame([(v,) for v in [0.0, 0.05, 0.1, 0.5, 1.0, 1.0, None]], "x double")
    got = op.histogram(frame, "x", 10).orderBy("bin").collect()
    assert [r.n for r in got] == [2, 1, 0, 0, 0, 1, 0, 0, 0, 2]
    assert (got[0].bin_start, got[9].bin_end) == (0.0, 1.0)


def test_histogram_matches_numpy(spark):
    import numpy as np

    values = [float(v) for v in np.random.default_rng(5).normal(size=500)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    counts, edges = np.histogram(values, bins=20)
    got = op.histogram(frame, "x").orderBy("bin").collect()
    assert [r.n for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == pytest.approx(edges[:-1].tolist())


@pytest.mark.parametrize("values, filled", [([3.0, 3.0], {10: 2}), ([], {})])
def test_histogram_of_one_value_or_none(spark, values, filled):
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.bin: r.n for r in op.histogram(frame, "x").collect()}
    assert got == {b: filled.get(b, 0) for b in range(20)}


def test_latest_row(spark):
    frame = times(spark, ["2024-01-01 00:00", "2024-01-01 00:30"], city="b")
    frame = frame.union(times(spark, ["2024-01-01 00:30"], city="a"))
    latest = op.latest_row(frame, "window_start")
    assert rows(latest, "city", "window_start") == [("a", utc("2024-01-01 00:30"))]
    per_city = op.latest_by_key(frame, "city", "window_start")
    assert rows(per_city, "city", "avg_util") == [("a", 0.0), ("b", 1.0)]
