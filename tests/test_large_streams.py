"""Streams over large feeds: tasks share the files of a stretch of time, and state does not follow the shuffles."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from pedalflow.plans import queries
from pedalflow.session import state_partitions
from pedalflow.sources.channels import read_messages, stream_messages
from pedalflow.streaming.jobs import finish
from pedalflow.streaming.state import state_stores

from helpers import plan_of


def _many_events(spark, folder, rows):
    """Tables of ``rows`` events in ten hours, of which every fifth is a view, of users in two nations."""
    n = F.col("id")
    kind = F.when(n % 5 == 0, "view").otherwise("click")
    at = F.timestamp_seconds(1_704_067_200 + (n * 36_000 / rows).cast("long")).cast("timestamp_ntz")
    props = F.format_string('{"k": %d}', n % 100)
    events = spark.range(rows).select(n.alias("event_id"), at.alias("ts"), (n % 50).alias("user_id"), kind.alias("event_type"), (n % 90).cast("double").alias("value"), props.alias("props"))
    users = spark.range(50).select(n.alias("c_custkey"), F.lit("x").alias("c_name"), (n % 2).cast("int").alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"))
    events.write.parquet(f"{folder}/events.parquet")
    users.write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    return folder


@pytest.mark.parametrize("resent", [False, True])
def test_a_stretch_of_time_is_as_many_files_in_one_batch(spark, scratch, monkeypatch, resent):
    """Also one with few rows or none: all but a few moments lie in the first and the last stretch."""
    monkeypatch.setattr(queries, "FILE_ROWS", 100)
    seconds = [*range(0, 2400), 6000, *range(9600, 12000, 4)]
    frame = spark.createDataFrame([(s,) for s in seconds], "s long").select(F.timestamp_seconds(1_704_067_200 + F.col("s")).alias("event_time"), "s")
    encode = lambda r: r.select(F.lit(b"k").alias("key"), F.col("s").cast("string").cast("binary").alias("value"))
    channel = queries._landed_in_order(spark, frame, encode, "messages", late=True, resent=resent)
    files = int(channel.options["maxFilesPerTrigger"])
    batches = {}

    def take(batch, batch_id):
        batches[batch_id] = sorted(int(r["value"]) for r in batch.select("value").collect())

    finish(stream_messages(spark, channel).writeStream.foreachBatch(take).option("checkpointLocation", f"{scratch}/c").trigger(availableNow=True).start())
    times = 2 if resent else 1
    stretch = lambda k: sorted(s for s in seconds if s * 4 // 11_997 == k for _ in range(times))
    assert files == -(-len(seconds) * times // 400) > 1
    assert [batches[k] for k in sorted(batches)] == [stretch(k) for k in (0, 1, 2, 3, 0)]


@pytest.mark.parametrize("rows", [2401, 3001])
def test_a_resent_message_is_read_and_encoded_once(spark, scratch, monkeypatch, rows):
    """A stretch has as many files for each core, and its messages go there without a second reading or a sort."""
    monkeypatch.setattr(queries, "FILE_ROWS", 100)
    frame = spark.range(rows).select(F.timestamp_seconds(1_704_067_200 + F.col("id")).alias("event_time"), "id")
    frame.write.parquet(f"{scratch}/rows")
    frame, plans = spark.read.parquet(f"{scratch}/rows"), []

    def spied(messages, channel, write=queries.write_messages):
        plans.append(plan_of(messages))
        write(messages, channel)

    monkeypatch.setattr(queries, "write_messages", spied)
    encode = lambda r: r.select(F.lit(b"k").alias("key"), F.col("id").cast("string").cast("binary").alias("value"))
    channel = queries._landed_in_order(spark, frame, encode, "messages", late=False, resent=True)
    assert int(channel.options["maxFilesPerTrigger"]) % spark.sparkContext.defaultParallelism == 0
    assert all(p.count("FileScan") == 1 and "RoundRobinPartitioning" not in p for p in plans[: queries.SLICES])
    sent = read_messages(spark, channel).groupBy("value").count()
    assert sent.count() == rows and sent.where("count != 2").count() == 0


@pytest.mark.parametrize("name", ["stream_usage_summary", "stream_usage_rollup", "stream_dedup_usage"])
def test_state_does_not_follow_the_shuffles_of_a_large_input(spark, scratch, monkeypatch, name):
    """Shuffles grow with the input; state stores, which cost time in each batch, are as many as there are cores."""
    folder, kept = _many_events(spark, f"{scratch}/in", 5000), []

    def spied(rows, *args, start=None, **more):
        kept.append((start(rows, *args, **more), args[1]))
        return kept[-1][0]

    for sink in ("start_files", "start_summary_sink"):
        monkeypatch.setattr(queries, sink, partial(spied, start=getattr(queries, sink)))
    with state_partitions(spark, 24):
        assert queries.QUERIES[name](spark, folder).count() > 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == "24"
    stores = state_stores(spark, kept[0][1]).collect()
    assert stores and {r["partitions"] for r in stores} == {spark.sparkContext.defaultParallelism}
