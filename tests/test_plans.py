"""What the optimizer makes of the queries."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from pedalflow.operators import enrich
from pedalflow.plans import queries as q
from pedalflow.session import stored


def parts(plan, word):
    return re.findall(rf"\b{word}\b", plan)


NO_MODEL = [name for name in q.QUERIES if not name.startswith(("stream_", "forecast_", "model_"))]


@pytest.mark.parametrize("name", NO_MODEL)
def test_no_cross_join_and_no_python(spark, small, name):
    plan = plan_of(q.QUERIES[name](spark, small))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert word not in plan


@pytest.mark.parametrize("name", ["usage_from_json_30m", "decode_status", "decode_weather", "static_snapshot"])
def test_each_message_is_parsed_once(spark, small, name):
    """One generator per feed, and no JSON parsing hidden in a filter or join condition."""
    plan = plan_of(q.QUERIES[name](spark, small))
    assert len(parts(plan, "Generate json_tuple")) == (2 if name == "usage_from_json_30m" else 1)
    assert "from_json" not in plan


def test_scan_reads_and_filters_what_is_needed(spark, small):
    plan = plan_of(q.QUERIES["usage_summary_30m"](spark, small))
    assert "Not(EqualTo(event_type,view))" in plan and "EqualTo(event_type,view)" in plan
    customer = next(line for line in plan.splitlines() if "customer.parquet" in line)
    assert "c_custkey" in customer and "c_acctbal" not in customer


def test_events_are_not_shuffled_for_a_small_customer_table(spark, small):
    plan = plan_of(q.QUERIES["utilization"](spark, small))
    assert "Exchange hashpartitioning" not in plan


def test_windows_are_reduced_before_the_only_shuffle(spark, small):
    """With broadcasts off: one shuffle per feed on (window, city), and the join adds none of its own.

    The other shuffles look up the user's region, which real feeds carry themselves.
    """
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(q._summary(spark, small))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [window" in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    by_window = [line for line in shuffles if re.search(r"hashpartitioning\(window#\d+, city#\d+", line)]
    assert len(by_window) == 2 and all("user_id" in line for line in shuffles if line not in by_window)
    assert len(parts(plan, "partial_avg")) == 5


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_a_hot_station_is_split(spark):
    """A third of all rows in one station: the join of a large snapshot is split over several tasks."""
    ids = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).cast("string")
    filling = F.sha2(F.col("id").cast("string"), 256)
    facts = spark.range(0, 300_000, 1, 8).select(ids.alias("station_id"), filling.alias("x"))
    stations = spark.range(5000).select(F.col("id").cast("string").alias("station_id"), F.col("id").alias("capacity"))
    stations = stored(stations, "stations")
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="200KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions=16,
    ):
        joined = enrich.enrich_status(facts, stations)
        assert joined.where("capacity IS NOT NULL").count() == 300_000
        widest = joined.groupBy("capacity").agg(F.max("x").alias("x"))
        widest.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(widest)


def test_latest_record_is_reduced_before_the_shuffle(spark, small):
    plan = plan_of(q.QUERIES["static_snapshot"](spark, small))
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max")


def test_latest_row_is_a_top_k(spark, small):
    assert "TakeOrderedAndProject(limit=1" in plan_of(q.QUERIES["latest_row"](spark, small))


@pytest.mark.parametrize("name", ["util_histogram", "test_label_histogram_by_time"])
def test_a_histogram_has_one_row_of_bounds(spark, small, name):
    """One scan for the bins, one for the counts, and the subquery with the bounds, named where they meet the values."""
    plan = plan_of(q.QUERIES[name](spark, small))
    assert plan.count("FileScan parquet") <= 4 and "Cartesian" not in plan and "NestedLoop" not in plan


def test_row_leads_use_chunks(spark, small):
    plan = plan_of(q.QUERIES["lead_rows"](spark, small))
    assert "WindowGroupLimit" in plan and "Exchange SinglePartition" not in plan
    leads = [line for line in plan.splitlines() if " Window [lead(" in line]
    assert leads and all("[city#" in line and "_chunk#" in line for line in leads)
