"""What a running stream tells: leads, scores, verdicts, state; each against the same worked out at rest."""

import json
import os
import random
import shutil
import warnings

import pytest
from pyspark.sql import functions as F

from helpers import bag, rows
from pedalflow import operators as op
from pedalflow import sources
from pedalflow.plans import forecast as fc
from pedalflow.schemas import STATION_STATUS
from pedalflow.session import fresh_path, state_partitions, stored
from pedalflow.sources import ledger
from pedalflow.streaming import finish, intake, live_features, read_intake, read_scores, start_files, start_intake_job, start_score_job, state_rows, state_stores

GRAIN = "30 minutes"


@pytest.fixture(scope="module")
def usage(spark):
    """Twelve days of half hours in two cities, some windows missing."""
    base = spark.range(0, 1152).where("id % 11 <> 3").select(
        F.timestamp_seconds(F.lit(1704067200) + F.expr("id div 2") * 1800).alias("window_start"),
        F.timestamp_seconds(F.lit(1704069000) + F.expr("id div 2") * 1800).alias("window_end"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("city"),
        *[(F.pmod(F.hash("id", F.lit(m)), F.lit(100)) / 100).alias(m) for m in ("avg_util", "max_util", "min_util", "std_util", "avg_temp", "avg_wind", "avg_clouds", "avg_rain")],
    )
    return stored(base, "usage")


def by_day(usage, path):
    """Each day a batch of one file, in order."""
    for day in range(1, 13):
        rows_of = stored(usage.where(F.dayofmonth("window_start") == day).coalesce(1), "day")
        sources.write_summary(rows_of, path, grain=GRAIN, batch_id=day)
        for root, _, files in os.walk(f"{path}/grain=30_minutes/run=batch/batch_id={day}"):
            for f in files:
                os.utime(f"{root}/{f}", (1_700_000_000 + day, 1_700_000_000 + day))


def test_leads_on_a_stream_are_those_at_rest(spark, usage, scratch):
    by_day(usage, scratch)
    out, checkpoint = fresh_path(spark, "out"), fresh_path(spark, "progress")
    with state_partitions(spark, 2):
        stream = sources.stream_summary(spark, scratch, GRAIN, maxFilesPerTrigger="1")
        query = start_files(op.lead_on_stream(stream, delay="1 hour"), out, checkpoint)
        finish(query)
    found, exact = spark.read.parquet(out), op.lead_by_time(usage)
    last = usage.agg(F.max("window_start")).first()[0]
    final = F.col("time_t1h").isNotNull() | (F.col("window_start") < F.lit(last) - F.expr("INTERVAL 2 HOURS"))
    assert bag(found) == bag(exact.where(final).select(*found.columns))
    assert found.where("time_t1h IS NULL").count() > 50
    assert len([p for p in query.recentProgress if p.numInputRows]) == 12
    # A day has about 90 rows; state keeps those of a few hours.
    held = [op.numRowsTotal for p in query.recentProgress[-3:] for op in p.stateOperators]
    assert held and max(held) < 300
    counted = rows(state_rows(spark, checkpoint), "operator", "store", "rows")
    assert counted and all(n < 300 for _, _, n in counted)
    assert rows(state_stores(spark, checkpoint).select("operator").distinct()) == [("symmetricHashJoin",)]


def test_resent_messages_count_once_and_are_forgotten(spark, scratch):
    data = [(f"s{k % 5}", 1704067200 + 60 * k, k % 7, "a") for k in range(2000)]
    shape = "station_id string, event_timestamp long, num_bikes_available int, city string"
    frame = spark.createDataFrame(data, shape).select("*", F.lit(3).alias("num_docks_available"))
    once = ["station_id", "event_time", "num_bikes_available", "city"]
    plain = op.utilization_by_window(op.with_event_time(frame))
    twice = op.with_event_time(frame.unionByName(frame))
    assert bag(op.flat_window(op.utilization_by_window(twice, once=once))) == bag(op.flat_window(plain))
    folder = f"{scratch}/rows"
    for k in range(8):
        part = frame.where(F.expr(f"(event_timestamp - 1704067200) div 15000 = {k}"))
        part.unionByName(part).coalesce(1).write.mode("append").parquet(folder)
    files = sorted((f for f in os.listdir(folder) if f.startswith("part")), key=lambda f: os.path.getmtime(f"{folder}/{f}"))
    for k, f in enumerate(files):
        os.utime(f"{folder}/{f}", (1_700_000_000 + k, 1_700_000_000 + k))
    out, checkpoint = fresh_path(spark, "out"), fresh_path(spark, "progress")
    with state_partitions(spark, 2):
        stream = op.with_event_time(spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder))
        query = start_files(op.flat_window(op.utilization_by_window(stream, delay=GRAIN, once=once)), out, checkpoint)
        finish(query)
    last = frame.agg(F.timestamp_seconds(F.max("event_timestamp"))).first()[0]
    closed = op.flat_window(plain).where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 30 MINUTES"))
    assert bag(spark.read.parquet(out)) == bag(closed)
    counted = {r["operator"]: r["rows"] for r in state_rows(spark, checkpoint).collect()}
    assert counted["dedupeWithinWatermark"] < 300 and counted["stateStoreSave"] < 10


@pytest.fixture(scope="module")
def features(usage):
    return stored(op.feature_rows(usage), "features")


def test_a_model_that_is_published_between_batches_serves_from_then_on(spark, usage, features, scratch):
    summary, models, out, progress = (f"{scratch}/{n}" for n in ("usage", "models", "scores", "progress"))
    assert fc.newest_model(spark, models) == (0, None)
    fitted = [fc.fit_forecast(features.where(F.dayofmonth("window_start") < d)).model for d in (5, 9)]
    for k, model in enumerate(fitted):
        sources.write_summary(usage.where(f"dayofmonth(window_start) {'<' if k == 0 else '>='} 7"), summary, grain=GRAIN, batch_id=k)
        assert fc.publish_model(model, models) == k + 1
        finish(start_score_job(spark, summary, models, out, progress))
    found = read_scores(spark, out)
    assert [tuple(r) for r in found.groupBy("model_version").agg(F.count("*")).orderBy("model_version").collect()] == [(1, 2), (2, 2)]
    for k, model in enumerate(fitted):
        part = usage.where("dayofmonth(window_start) < 7") if k == 0 else usage
        latest = op.latest_by_key(part, "city", "window_start")
        expected = fc.score(model, live_features(latest)).select("window_start", "city", "time_t1h", "prediction")
        assert bag(found.where(F.col("model_version") == k + 1).select(*expected.columns)) == bag(expected)


def test_a_model_that_cannot_be_read_leaves_the_old_one(spark, usage, features, scratch):
    summary, models, out, progress = (f"{scratch}/{n}" for n in ("usage", "models", "scores", "progress"))
    from pedalflow.streaming.scoring import NewestModel

    newest = NewestModel(models)
    with pytest.raises(ValueError, match="no model"):
        newest.get(spark)
    fc.publish_model(fc.fit_forecast(features).model, models)
    assert newest.get(spark)[0] == 1
    ledger.publish(spark, models, ledger.Entry("model", "version-2-gone", 2))
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert newest.get(spark)[0] == 1 and told
    fc.publish_model(fc.fit_forecast(features).model, models)
    assert newest.get(spark)[0] == 3


def test_intake_keeps_what_it_rejects(spark, scratch):
    """Every message has one outcome, rejected ones their text; a batch that is run again judges as before."""
    start = 1704067200
    good = lambda at, key="s1": (key, json.dumps({"station_id": key, "num_bikes_available": 1, "num_docks_available": 2, "city": "a", "event_timestamp": at}))
    batches = [
        [good(start), good(start + 7200), ("s1", "no json"), good(start, ""), ("s2", '{"station_id": "s2"}')],
        [good(start + 60), good(start + 7000), good(start + 9000), ("s3", None), good(start + 10**7)],
        [good(start + 7300), good(start + 10_900)],
    ]
    channel = sources.file_channel(f"{scratch}/status", maxFilesPerTrigger="1")
    for k, messages in enumerate(batches):
        frame = spark.createDataFrame([(a.encode(), b and b.encode()) for a, b in messages], "key binary, value binary")
        frame = frame.withColumn("timestamp", F.timestamp_seconds(F.lit(start + 12_000))).withColumn("offset", F.lit(k).cast("long"))
        sources.write_messages(frame.coalesce(1), channel)
    out, progress = f"{scratch}/intake", f"{scratch}/progress"
    finish(start_intake_job(spark, channel, STATION_STATUS, "station_id", out, progress))
    expected = sorted(
        [(0, "loaded", 2), (0, "corrupt", 1), (0, "no_key", 1), (0, "bad_time", 1)]
        # The watermark of the second batch is at start + 5400: the first window is final, the one up to 7200 is not.
        + [(1, "late", 1), (1, "loaded", 2), (1, "bad_time", 1), (1, "no_key", 1)]
        + [(2, "loaded", 2)]
    )
    found = read_intake(spark, out, STATION_STATUS)
    assert rows(found.groupBy("batch_id", "outcome").count(), "batch_id", "outcome", "count") == expected
    assert [r["raw"] for r in found.where("outcome = 'corrupt' and batch_id = 0").collect()] == ["no json"]
    # The last batch failed before its commit was written: it runs again and replaces its folder.
    os.remove(f"{progress}/commits/2")
    shutil.rmtree(f"{progress}/intake/batch_id=2")
    for name in os.listdir(f"{progress}/commits"):
        if name.startswith(".2"):
            os.remove(f"{progress}/commits/{name}")
    finish(start_intake_job(spark, channel, STATION_STATUS, "station_id", out, progress))
    assert rows(read_intake(spark, out, STATION_STATUS).groupBy("batch_id", "outcome").count(), "batch_id", "outcome", "count") == expected


def test_late_is_what_a_window_would_drop(spark):
    rng = random.Random(4)
    moments = [1704067200 + rng.randrange(0, 20_000) for _ in range(300)]
    texts = [json.dumps({"station_id": "s", "event_timestamp": m}) for m in moments]
    frame = spark.createDataFrame([(t.encode(),) for t in texts], "value binary").withColumn("timestamp", F.lit(None).cast("timestamp"))
    watermark = 1704067200 + 9_000.5
    got = intake.judged(frame, STATION_STATUS, "station_id", watermark).select("event_timestamp", "outcome").collect()
    for r in got:
        end = (r["event_timestamp"] // 1800 + 1) * 1800
        assert r["outcome"] == ("late" if end <= watermark else "loaded")
