"""As-of joins, trailing features and rollups against plain Python, across the ends of chunks."""

import math
import random
import re
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import bag, plan_of
from pedalflow import operators as op
from pedalflow.plans import queries as q

START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


@pytest.mark.parametrize("chunk_hours", [0.5, 24, 24 * 365])
def test_as_of_takes_the_latest_record_at_or_before(spark, chunk_hours):
    rng = random.Random(3)
    # One station has a third of all rows.
    key = lambda: rng.choice(["hot", "hot", "a", "b", "c", None])
    rows = [(i, key(), at(rng.randrange(0, 6000))) for i in range(600)] + [(600, "hot", None), (601, "unknown", at(5))]
    history = [(rng.choice(["hot", "a", "b", None]), at(rng.randrange(0, 6000, 10)), k, f"name {k}") for k in range(80)]
    history += [("hot", at(100), 900, "tie"), ("hot", at(100), 901, "later tie"), ("a", None, 902, "no time")]
    left = spark.createDataFrame(rows, "id int, station_id string, event_time timestamp")
    right = spark.createDataFrame(history, "station_id string, valid_from timestamp, version int, name string")
    got = {r["id"]: r["name"] for r in op.join_as_of(left, right, "station_id", order="version", chunk_hours=chunk_hours).collect()}
    for i, station, moment in rows:
        known = [h for h in history if None not in (station, moment, h[1]) and h[0] == station and h[1] <= moment]
        assert got.pop(i) == (max(known, key=lambda h: h[1:3])[3] if known else None)
    assert not got


def test_as_of_of_nothing(spark):
    left = spark.createDataFrame([(1, "a", at(0))], "id int, station_id string, event_time timestamp")
    right = spark.createDataFrame([], "station_id string, valid_from timestamp, name string")
    assert [r["name"] for r in op.join_as_of(left, right, "station_id").collect()] == [None]
    assert op.join_as_of(left.limit(0), right, "station_id").collect() == []


SPANS = {"1h": "1 hour", "3d": "3 days"}
LENGTHS = {"1h": timedelta(hours=1), "3d": timedelta(days=3)}


@pytest.mark.parametrize("chunk_hours", [1, 24])
def test_trailing_features_against_plain_sums(spark, chunk_hours):
    rng = random.Random(5)
    rows = []
    for city in ("a", "b", None):
        for k in sorted(rng.sample(range(400), 150)):
            rows.append((at(30 * k), city, rng.choice([None, 0.25, 0.25, rng.random()])))
    frame = spark.createDataFrame(rows, "window_start timestamp, city string, avg_util double")
    for r in op.trailing_features(frame, SPANS, chunk_hours=chunk_hours).collect():
        own = [(t, None if x is None else round(x, 6)) for t, c, x in rows if c == r["city"]]
        for name, length in LENGTHS.items():
            inside = [x for t, x in own if r["window_start"] - length <= t <= r["window_start"] and x is not None]
            assert r[f"n_{name}"] == len(inside)
            assert r[f"mean_{name}"] == (pytest.approx(statistics.fmean(inside), abs=1e-12) if inside else None)
            assert r[f"std_{name}"] == (pytest.approx(statistics.stdev(inside), abs=1e-9) if len(inside) > 1 else None)
            if len(set(inside)) == 1 and len(inside) > 1:
                assert r[f"std_{name}"] == 0.0
            assert r[f"lag_{name}"] == next((x for t, x in own if t == r["window_start"] - length), None)


@pytest.mark.parametrize("name", ["trailing_features", "status_enriched_asof"])
def test_no_window_sorts_a_whole_key(spark, small, name):
    """Rows are sorted within chunks; what is lined up per key is one aggregated row for each chunk."""
    plan = plan_of(q.QUERIES[name](spark, small))
    windows = [line for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    whole = [line for line in windows if "_chunk" not in line.split("], [")[1]]
    assert windows and all("specifiedwindowframe(RowFrame, unboundedpreceding$(), -1)" in line for line in whole)
    for line in whole:
        after = plan[plan.index(line) + len(line) :]
        assert re.search(r"(Sort)?(Object|Hash)?Aggregate\(", after[: after.index("FileScan")])


def test_moments_lose_no_digits(spark):
    """A large common part would swallow the deviations in a difference of sums."""
    rng = random.Random(1)
    values = [(START + timedelta(seconds=7 * k), "a", 1e9 + rng.random()) for k in range(1500)]
    rows = spark.createDataFrame(values, "event_time timestamp, city string, utilization double")
    longer = op.utilization_of(op.rollup(op.moments_by_window(rows)))
    for r in longer.collect():
        inside = [x for t, _, x in values if r["window"]["start"] <= t < r["window"]["end"]]
        assert r["std_util"] == pytest.approx(statistics.stdev(inside), rel=1e-5)
        assert (r["max_util"], r["min_util"]) == (max(inside), min(inside)) and r["avg_util"] == pytest.approx(statistics.fmean(inside))


def test_windows_without_values_roll_up_to_nulls(spark):
    values = [(at(0), "a", None), (at(5), "a", None), (at(40), "a", None), (at(41), "a", 0.5), (at(70), None, 0.25)]
    rows = spark.createDataFrame(values, "event_time timestamp, city string, utilization double")
    got = op.utilization_of(op.rollup(op.moments_by_window(rows))).select("window.start", "city", "avg_util", "max_util", "std_util")
    assert bag(got) == bag(spark.createDataFrame([(at(0), "a", None, None, None), (at(30), "a", 0.5, 0.5, None), (at(60), None, 0.25, 0.25, None)], got.schema))


def test_folds_train_on_what_was_known(spark):
    """No training row's label lies at or after the first test row of its fold."""
    rows = spark.range(200).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("window_start"))
    rows = rows.withColumn("time_t1h", F.col("window_start") + F.expr("INTERVAL 1 HOUR"))
    cutoffs = ["2024-01-02 00:00:00", "2024-01-03 00:00:00", "2024-01-09 00:00:00"]
    got = op.folds(rows, cutoffs)
    sizes = {(r["fold"], r["part"]): r["count"] for r in got.groupBy("fold", "part").count().collect()}
    assert sizes == {(0, "train"): 46, (0, "test"): 48, (1, "train"): 94, (1, "test"): 104, (2, "train"): 200}
    ends = got.groupBy("fold").agg(F.max(F.when(F.col("part") == "train", F.col("time_t1h"))).alias("known"), F.min(F.when(F.col("part") == "test", F.col("window_start"))).alias("first"))
    assert ends.where("known >= first").isEmpty()
    tests = got.where("part = 'test'")
    assert tests.count() == tests.select("window_start").distinct().count()


def test_quantile_bins_hold_equal_shares(spark):
    """Every end has about its rank among the exact values, in each city, a hot one too."""
    rng = random.Random(2)
    values = [(rng.choice(["hot", "hot", "a"]), rng.gauss(0, 1) ** 3) for _ in range(30_000)] + [("a", None), ("a", math.nan), ("none", None)]
    frame = spark.createDataFrame(values, "city string, v double").repartition(6)
    got = op.quantile_bins(frame, "v", 20, ["city"]).collect()
    assert {r["city"] for r in got} == {"hot", "a"}
    for city in ("hot", "a"):
        exact = sorted(v for c, v in values if c == city and v is not None and not math.isnan(v))
        own = sorted((r for r in got if r["city"] == city), key=lambda r: r["bin"])
        assert [r["bin"] for r in own] == list(range(20)) and {r["n"] for r in own} == {len(exact)}
        assert own[0]["bin_start"] == exact[0] and own[-1]["bin_end"] == exact[-1]
        for r in own[:-1]:
            share = sum(v <= r["bin_end"] for v in exact) / len(exact)
            assert abs(share - (r["bin"] + 1) / 20) < 0.015
