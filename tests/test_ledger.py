"""Folders that count: published whole, compacted without a moment in which rows are missing or doubled."""

import pytest
from pyspark.sql import functions as F

from helpers import bag
from pedalflow import sources
from pedalflow.plans import queries as q
from pedalflow.session import fresh_path, stored
from pedalflow.sources import ledger
from pedalflow.streaming import finish, start_files

GRAIN = "30 minutes"


@pytest.fixture(scope="module")
def usage(spark, small):
    return stored(q._summary(spark, small), "usage")


def batch(usage, k, of=3):
    return usage.where(F.pmod(F.hash("window_start", "city"), F.lit(of)) == k)


def wrote(usage, path, fmt="parquet"):
    for k in range(3):
        sources.write_summary(batch(usage, k), path, fmt, GRAIN, k)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_compaction_changes_no_row(spark, usage, scratch, fmt):
    wrote(usage, scratch, fmt)
    before = bag(sources.read_summary(spark, scratch, fmt, GRAIN))
    assert sum(before.values()) == usage.count()
    assert sources.compact_summary(spark, scratch, GRAIN, fmt) == 3
    after = sources.read_summary(spark, scratch, fmt, GRAIN)
    assert bag(after) == before and len(after.inputFiles()) == 1
    assert sources.compact_summary(spark, scratch, GRAIN, fmt) == 0


def test_a_compaction_that_ends_halfway_leaves_what_was(spark, usage, scratch, monkeypatch):
    wrote(usage, scratch)
    before = bag(usage)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(ledger, "publish", fail)
        with pytest.raises(RuntimeError, match="lost"):
            sources.compact_summary(spark, scratch, GRAIN)
    assert bag(sources.read_summary(spark, scratch, grain=GRAIN)) == before
    assert sources.compact_summary(spark, scratch, GRAIN) == 3
    assert bag(sources.read_summary(spark, scratch, grain=GRAIN)) == before


def test_a_batch_run_again_after_its_compaction_counts_once(spark, usage, scratch):
    wrote(usage, scratch)
    sources.compact_summary(spark, scratch, GRAIN)
    sources.write_summary(batch(usage, 2), scratch, grain=GRAIN, batch_id=2)
    assert bag(sources.read_summary(spark, scratch, grain=GRAIN)) == bag(usage)
    assert sources.expire_summary(spark, scratch, GRAIN, 3600) == 0
    assert sources.expire_summary(spark, scratch, GRAIN, -10) == 3
    sources.write_summary(batch(usage, 2), scratch, grain=GRAIN, batch_id=2)
    assert bag(sources.read_summary(spark, scratch, grain=GRAIN)) == bag(usage)


def test_generations_replace_each_other_and_grains_stay_apart(spark, usage, scratch):
    wrote(usage, scratch)
    sources.write_summary(usage.limit(4), scratch, grain="1 minute")
    sources.compact_summary(spark, scratch, GRAIN)
    sources.write_summary(usage, scratch, grain=GRAIN, batch_id=3)
    assert sources.compact_summary(spark, scratch, GRAIN) == 2
    twice = bag(usage.unionByName(usage))
    assert bag(sources.read_summary(spark, scratch, grain=GRAIN)) == twice
    assert sources.expire_summary(spark, scratch, GRAIN, -10) == 5
    assert bag(sources.read_summary(spark, scratch, grain=GRAIN)) == twice
    assert sources.read_summary(spark, scratch, grain="1 minute").count() == 4


def test_the_slower_of_two_compactions_is_refused(spark, usage, scratch):
    wrote(usage, scratch)
    real = ledger.entries

    def overtaken(*args):
        found = real(*args)
        if not any(e.generation for e in found):
            ledger.publish(spark, scratch, ledger.Entry("30_minutes", "elsewhere", 1, ("nothing",)))
        return found

    ledger.entries = overtaken
    try:
        with pytest.raises(RuntimeError, match="faster"):
            sources.compact_summary(spark, scratch, GRAIN)
    finally:
        ledger.entries = real


def test_a_stream_reads_batches_and_no_generation(spark, usage, scratch):
    out, progress = fresh_path(spark, "out"), fresh_path(spark, "progress")
    stream = lambda: sources.stream_summary(spark, scratch, GRAIN)
    wrote(usage, scratch)
    finish(start_files(stream(), out, progress))
    sources.compact_summary(spark, scratch, GRAIN)
    sources.write_summary(usage.limit(2), scratch, grain=GRAIN, batch_id=3)
    finish(start_files(stream(), out, progress))
    assert spark.read.parquet(out).count() == usage.count() + 2


def test_a_dataset_without_entries_is_read_whole(spark, usage, scratch):
    usage.write.parquet(f"{scratch}/grain=30_minutes/run=batch/batch_id=0")
    assert bag(sources.read_summary(spark, scratch, grain=GRAIN)) == bag(usage)
