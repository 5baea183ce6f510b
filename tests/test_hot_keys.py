"""Hot timelines are cut; results equal those of the plain window, whatever the skew."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallymark.functions import messages as M
from tallymark.operators import history as H, hotkeys
from tallymark.plans import events


def rows(df):
    return sorted(tuple(str(v) for v in row) for row in df.select(*sorted(df.columns)).collect())


def skewed(spark, kind, count=6000):
    """Records of which a third or more are of request 0."""
    base = spark.range(count).select(F.col("id").alias("seq"))
    hot = F.col("seq") % 3 != 1
    moment = {
        "spread": F.col("seq") * 7 % count,
        "burst": F.when(hot, F.lit(17)).otherwise(F.col("seq")),
        "mixed": F.when(F.col("seq") % 2 == 0, F.lit(17)).otherwise(F.col("seq") % 40),
        "timeless": F.when(F.col("seq") % 4 > 0, F.col("seq") % 40),
    }[kind]
    types = F.when(F.col("seq") % 5 == 0, F.lit("TRADE_DATA")).otherwise(F.lit("MARKET_DATA"))
    return base.select(
        F.when(hot, F.lit("REQ-0")).otherwise(F.concat(F.lit("REQ-"), F.col("seq") % 50)).alias("req_id"),
        F.when(~hot, F.lit("FO-0")).alias("fo_id"),
        types.alias("type"),
        F.timestamp_seconds(moment).cast("timestamp_ntz").alias("ts"),
        "seq",
    )


KINDS = ["spread", "burst", "mixed", "timeless"]


@pytest.mark.parametrize("kind", KINDS)
def test_running_counts_equal_plain_window(spark, kind):
    data = skewed(spark, kind)
    plain = H.running_counts(data, hot_rows=None)
    assert rows(H.running_counts(data, hot_rows=200)) == rows(plain)


def test_running_counts_through_several_levels_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(hotkeys, "FAN", 3)
    monkeypatch.setattr(hotkeys, "BROADCAST_ROWS", 0)
    data = skewed(spark, "mixed")
    found = H.running_counts(data, hot_rows=120)
    assert rows(found) == rows(H.running_counts(data, hot_rows=None))


def test_text_orders_a_timeline_as_well(spark):
    data = skewed(spark, "spread").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    assert rows(H.running_counts(data, hot_rows=200)) == rows(H.running_counts(data, hot_rows=None))


@pytest.mark.parametrize("count", [6000, 60_000])
@pytest.mark.parametrize("kind", KINDS)
def test_tiles_do_not_grow_with_the_rows(spark, kind, count):
    split = hotkeys.split_hot_keys(skewed(spark, kind, count), M.KEYS, ("ts", "seq"), hot_rows=500)
    largest = split.hot.groupBy(hotkeys.TILE).count().agg(F.max("count")).first()[0]
    assert largest < 1000
    assert split.hot.count() + split.plain.count() == count


def test_thousands_of_hot_requests(spark):
    data = spark.range(90_000).select(
        (F.col("id") % 3000).alias("req_id"), F.lit(None).cast("string").alias("fo_id"), F.lit("TRADE_DATA").alias("type"),
        F.col("id").alias("seq"), F.lit(1).alias("ts"),
    )
    split = hotkeys.split_hot_keys(data, M.KEYS, ("ts", "seq"), hot_rows=20)
    assert split.plain.count() == 0 and split.tiles == 4500
    found = H.running_counts(data, hot_rows=20)
    assert found.where("running_trade_data <> seq DIV 3000 + 1").count() == 0
    assert found.count() == 90_000


def test_tiles_follow_the_order(spark):
    split = hotkeys.split_hot_keys(skewed(spark, "mixed"), M.KEYS, ("ts", "seq"), hot_rows=200)
    ordered = split.hot.where("req_id = 'REQ-0'").orderBy("ts", "seq").select(hotkeys.TILE).collect()
    tiles = [row[0] for row in ordered]
    assert tiles == sorted(tiles) and len(set(tiles)) > 10


def test_nothing_is_cut_below_the_limit(spark):
    assert hotkeys.split_hot_keys(skewed(spark, "spread"), M.KEYS, ("ts", "seq")).hot is None


def test_no_window_spans_a_hot_timeline(spark):
    """Windows over hot rows are by tile, and those over totals by block of tiles."""
    data = skewed(spark, "spread")
    plan = H.running_counts(data, hot_rows=200)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Window")]
    assert len(windows) == 3
    assert sum(hotkeys.TILE in line for line in windows) == 2


def test_first_completion_equals_plain(spark, sf_dir):
    control, data = events.control(spark, sf_dir), events.data(spark, sf_dir)
    one_key = ("all",)
    control = control.withColumn("all", F.lit(1)).drop(*events.KEYS)
    data = data.withColumn("all", F.col("user_id") % 3).drop(*events.KEYS)
    plain = H.first_completion(control, data, one_key, hot_rows=None)
    assert rows(H.first_completion(control, data, one_key, hot_rows=500)) == rows(plain)


@pytest.mark.parametrize("kind", ["spread", "burst"])
@pytest.mark.parametrize("fan", [3, hotkeys.FAN])
def test_first_completion_with_revisions_in_a_hot_timeline(spark, kind, fan, monkeypatch):
    """Announcements arrive all along the timeline; the current one must be carried over cuts."""
    monkeypatch.setattr(hotkeys, "FAN", fan)
    data = skewed(spark, kind)
    control = data.where("seq % 97 = 0").select(
        *M.KEYS, "ts", "seq", F.create_map(
            F.lit("TRADE_DATA"), (F.col("seq") / 9).cast("bigint"),
            F.lit("MARKET_DATA"), (F.col("seq") / 2).cast("bigint")).alias("statistics"),
    )
    plain = H.first_completion(control, data, hot_rows=None)
    assert rows(H.first_completion(control, data, hot_rows=200)) == rows(plain)


def test_edges_equal_plain(spark):
    states = skewed(spark, "spread").select(
        *M.KEYS, F.col("ts").alias("snapshot_ts"), (F.col("seq") % 4 - 1).alias("delta_trade_data"),
        F.lit(0).cast("bigint").alias("delta_market_data"),
    )
    unique = states.dropDuplicates([*M.KEYS, "snapshot_ts"])
    plain = H.newly_completed(unique, edge="both", hot_rows=None)
    assert rows(H.newly_completed(unique, edge="both", hot_rows=200)) == rows(plain)
