"""The plans are the intended ones: what is read, what is shuffled, what stays in the JVM."""

from __future__ import annotations

import __spark_entry__ as contract
import pytest
from frames import control_frame, data_frame
from pyspark.sql import Column, functions as F

from tallymark.operators import counting, reconcile as R
from tallymark.plans import orders
from tallymark.streaming.feed import delivery_feed

# These run jobs of their own before they return a frame.
STREAMS = {"state_snapshot", "state_history", "published_status", "published_repeatedly", "consumed_notices"}
STREAMS |= {name for name in contract.queries() if name.startswith("stream_")}
BATCH = sorted(set(contract.queries()) - set(contract.TEXT_QUERIES) - STREAMS)


@pytest.fixture
def at_scale(spark):
    """Plan as if no table were small enough to broadcast."""
    before = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, node):
    return sum(line.lstrip(" :+-*()0123456789").startswith(node) for line in plan.splitlines())


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_single_task(name, spark, small_dir, at_scale):
    plan = plan_of(contract.queries()[name](spark, small_dir))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython", "CollectLimit"):
        if name == "snapshot_edges" and forbidden == "SinglePartition":
            # The latest snapshot time: map-side maxima into one row.
            continue
        assert forbidden not in plan, plan


@pytest.mark.parametrize("name", sorted(set(BATCH) - {"decode_protobuf"}))
def test_only_protobuf_uses_python(name, spark, small_dir):
    plan = plan_of(contract.queries()[name](spark, small_dir))
    assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_reconcile_shares_scan_and_partitioning(spark, small_dir, at_scale):
    plan = plan_of(orders.reconcile_status(spark, small_dir))
    # Orders and counted line items are shuffled once each; the second use of the counts is a reuse.
    assert count(plan, "Exchange hashpartitioning") == 2
    assert count(plan, "ReusedExchange") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_linestatus:string>" in plan
    assert "partial_count" in plan


def test_reconcile_of_two_inputs_has_one_shuffle_each(spark, at_scale):
    control = control_frame(spark, [(0, 1, 0, 0)])
    data = data_frame(spark, [(0, "T", 1)])
    plan = plan_of(R.reconcile(control, data))
    assert count(plan, "Exchange hashpartitioning") == 2
    assert plan.count("partial_count") >= 1 and plan.count("partial_max_by") >= 1
    assert "Window" not in plan


def test_latest_control_is_an_aggregate(spark, at_scale):
    control = control_frame(spark, [(0, 1, 0, 0)])
    plan = plan_of(R.latest_control(control, order_by=("ts", "seq")))
    assert "Window" not in plan and "partial_max_by" in plan


def test_newest_declaration_by_time_and_number_is_a_hash_aggregate(spark, small_dir, at_scale):
    plan = plan_of(orders.latest_declared(spark, small_dir))
    assert "SortAggregate" not in plan and "partial_max_by" in plan
    control, data = control_frame(spark, [(0, 1, 0, 0)]), data_frame(spark, [(0, "T", 1)])
    assert "SortAggregate" not in plan_of(R.reconcile(control, data, order_by=("ts", "seq")))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_packed_order_is_the_order_of_time_and_number(spark, kind):
    times = [None, "0001-01-01", "1969-12-31 23:59:59.999999", "1970-01-01", "2024-03-31 02:30:00.000001", "2024-10-27 02:30:00", "9999-12-31"]
    numbers = [None, -(2**63), -1, 0, 5, 2**63 - 1]
    rows = [(t, n, i * 10 + k) for i, t in enumerate(times) for k, n in enumerate(numbers)]
    df = spark.createDataFrame(rows, "t string, n bigint, place int").withColumn("t", F.col("t").cast(kind))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        for first in (True, False):
            packed = R.ordering(df, ("t", "n"), unknown_first=first)
            nulls = Column.asc_nulls_first if first else Column.asc_nulls_last
            want = df.orderBy(nulls(F.col("t")), nulls(F.col("n"))).select("place").collect()
            assert df.orderBy(packed).select("place").collect() == want
        distinct = df.select("t", "n").distinct().count()
        assert df.select(R.ordering(df, ("t", "n"))).distinct().count() == distinct
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_dedup_drops_unused_columns_before_the_shuffle(spark, at_scale):
    data = data_frame(spark, [(0, "T", 1)])
    plan = plan_of(counting.type_counts(R.dedup_data(data)))
    assert "SortAggregate" not in plan and "first(" not in plan


def test_control_totals_is_one_shuffle(spark, small_dir, at_scale):
    plan = plan_of(orders.control_totals(spark, small_dir))
    assert count(plan, "Exchange") == 1
    assert "collect_list" not in plan


def test_ids_values_and_names_never_reach_the_stream_state(spark):
    feed = delivery_feed(control_frame(spark, [(0, 1, 0, 0)]), data_frame(spark, [(0, "T", 1)]))
    assert not {"id", "value", "fo_name", "statistics"} & set(feed.columns)


def test_filter_on_a_key_reaches_the_scan(spark, small_dir):
    plan = plan_of(orders.reconcile_status(spark, small_dir).where(F.col("status") == "OVER"))
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
