"""Batch operators on hand-made messages."""

from __future__ import annotations

from datetime import timezone

import pytest
from frames import at, control_frame, data_frame, key
from pyspark.sql import functions as F

from tallymark.operators import counting, history as H, reconcile as R


def by_request(df, column):
    return {row["req_id"]: row[column] for row in df.collect()}


def test_reconcile_covers_every_status(spark):
    control = control_frame(spark, [(0, 1, 1, 0), (1, 0, 0, 0), (2, 2, 0, 0), (3, 1, 0, 0), (4, 2, 1, 0)])
    data = data_frame(
        spark,
        [(0, "T", 1), (0, "M", 2), (3, "T", 1), (3, "T", 2), (4, "T", 1), (5, "M", 1), (0, "U", 9)],
    )
    assert by_request(R.reconcile(control, data), "status") == {
        "REQ-0": "COMPLETE",
        "REQ-1": "COMPLETE",
        "REQ-2": "NO_DATA",
        "REQ-3": "OVER",
        "REQ-4": "INCOMPLETE",
        "REQ-5": "NO_CTRL",
    }


def test_key_is_both_columns(spark):
    control = control_frame(spark, [(0, 1, 0, 0)])
    data = data_frame(spark, [(0, "T", 1)]).withColumn("fo_id", F.lit("FO-other"))
    assert sorted(r["status"] for r in R.reconcile(control, data).collect()) == ["NO_CTRL", "NO_DATA"]


def test_latest_control_breaks_ties_by_sequence(spark):
    control = control_frame(spark, [(0, 1, 0, 5, 1), (0, 2, 0, 5, 2), (0, 9, 0, 4, 3)])
    newest = R.latest_control(control, order_by=("ts", "seq")).collect()
    assert [row["statistics"]["TRADE_DATA"] for row in newest] == [2]
    declared = R.latest_declared(control, order_by=("ts", "seq")).collect()
    assert [row["declared_trade_data"] for row in declared] == [2]


def test_an_incomplete_announcement_replaces_a_complete_one(spark):
    control = control_frame(spark, [(0, 1, 0, 0), (0, 1, None, 5)])
    data = data_frame(spark, [(0, "T", 1)])
    assert by_request(R.reconcile(control, data, missing="quarantine"), "status") == {"REQ-0": "BAD_CTRL"}


def test_announcements_without_time_count_where_there_is_no_other(spark):
    control = control_frame(spark, [(0, 1, 0, 0), (1, 2, 0, 0), (1, 1, 0, 1)])
    timeless = F.when(F.col("statistics")["TRADE_DATA"] != 2, F.col("ts")).alias("ts")
    gone = control.withColumn("ts", F.when(F.col("req_id") == "REQ-1", timeless))
    data = data_frame(spark, [(0, "T", 1), (1, "T", 1)])
    assert set(by_request(R.reconcile(gone, data), "status").values()) == {"COMPLETE"}
    newest = by_request(R.latest_control(gone), "statistics")
    assert {key: value["TRADE_DATA"] for key, value in newest.items()} == {"REQ-0": 1, "REQ-1": 1}


def test_merged_announcements_can_be_reconciled(spark):
    control = control_frame(spark, [(0, 1, 0, 0)])
    merged = counting.merge_control(control, control_frame(spark, [(0, 2, 0, 3)]))
    assert by_request(R.reconcile(merged, data_frame(spark, [(0, "T", 1), (0, "T", 2)])), "status") == {"REQ-0": "COMPLETE"}
    assert merged.collect()[0]["ts"] is not None


def test_missing_type_policies(spark):
    control = control_frame(spark, [(0, 1, None, 0), (1, 1, 1, 0)])
    data = data_frame(spark, [(0, "T", 1)])
    assert by_request(counting.declared_counts(control), "declared_market_data") == {"REQ-0": 0, "REQ-1": 1}
    flagged = counting.declared_counts(control, missing="quarantine")
    assert by_request(flagged, "error") == {"REQ-0": "MISSING_TYPE:MARKET_DATA", "REQ-1": None}
    assert by_request(R.reconcile(control, data, missing="quarantine"), "status")["REQ-0"] == "BAD_CTRL"
    with pytest.raises(Exception, match="no entry for MARKET_DATA"):
        counting.declared_counts(control, missing="fail").collect()
    with pytest.raises(ValueError):
        counting.declared_counts(control, missing="ignore")


def test_dedup_keeps_types_apart_and_can_keep_the_first(spark):
    data = data_frame(spark, [(0, "T", 3), (0, "T", 1), (0, "M", 2)]).withColumn("id", F.lit("Trade-0"))
    assert R.dedup_data(data).count() == 2
    first = R.dedup_data(data, order_by=("ts", "seq")).where("type = 'TRADE_DATA'").collect()
    assert [row["ts"].replace(tzinfo=timezone.utc) for row in first] == [at(1)]


def test_more_than_two_types(spark):
    types = ("TRADE_DATA", "MARKET_DATA", "REFERENCE_DATA")
    control = spark.createDataFrame(
        [(*key(0), {"TRADE_DATA": 1, "MARKET_DATA": 0, "REFERENCE_DATA": 1}, at(0))],
        "req_id string, fo_id string, statistics map<string,bigint>, ts timestamp",
    )
    data = spark.createDataFrame(
        [(*key(0), "TRADE_DATA"), (*key(0), "REFERENCE_DATA")], "req_id string, fo_id string, type string"
    )
    assert by_request(R.reconcile(control, data, types=types), "status") == {"REQ-0": "COMPLETE"}
    assert by_request(R.reconcile(control, data.limit(1), types=types), "status") == {"REQ-0": "INCOMPLETE"}


def test_control_totals_roundtrip_is_complete(spark):
    data = data_frame(spark, [(0, "T", 1), (0, "M", 2), (0, "M", 3), (1, "U", 1)])
    totals = counting.control_totals(data).withColumn("ts", F.lit(at(0)))
    assert by_request(totals, "statistics") == {
        "REQ-0": {"TRADE_DATA": 1, "MARKET_DATA": 2},
        "REQ-1": {"TRADE_DATA": 0, "MARKET_DATA": 0},
    }
    assert set(by_request(R.reconcile(totals, data), "status").values()) == {"COMPLETE"}


def test_completed_and_notifications(spark):
    control = control_frame(spark, [(0, 1, 0, 0), (1, 2, 0, 0), (2, 1, 0, 0)])
    data = data_frame(spark, [(0, "T", 1), (1, "T", 1), (2, "T", 1), (2, "T", 2)])
    delta = R.completion_delta(control, data)
    assert by_request(R.completed(delta), "delta_trade_data") == {"REQ-0": 0}
    assert by_request(R.notifications(R.completed(R.reconcile(control, data))), "message") == {
        "REQ-0": "REQ-0 Finished."
    }


def test_first_completion_is_checked_after_every_message(spark):
    control = control_frame(spark, [(0, 1, 1, 0), (1, 2, 0, 5), (2, 0, 0, 7), (3, 1, 0, 4), (4, 5, 0, 0), (4, 1, 0, 9)])
    data = data_frame(
        spark,
        [
            (0, "T", 1), (0, "M", 2), (0, "T", 3),  # complete at 2, over-delivered later
            (1, "T", 1), (1, "T", 2),  # data first: complete when announced
            (3, "T", 4),  # same moment: control comes first
            (4, "T", 1),  # complete by revision
        ],
    )
    first = H.first_completion(control, data)
    seconds = {r["req_id"]: int((r["completed_at"].replace(tzinfo=timezone.utc) - at(0)).total_seconds()) for r in first.collect()}
    assert seconds == {"REQ-0": 2, "REQ-1": 5, "REQ-2": 7, "REQ-3": 4, "REQ-4": 9}


def _states(spark, rows):
    return spark.createDataFrame(
        [(*key(n), at(seconds), delta, 0) for n, seconds, delta in rows],
        "req_id string, fo_id string, snapshot_ts timestamp, delta_trade_data bigint, delta_market_data bigint",
    )


def _edges(df):
    return sorted((r["req_id"], int((r["snapshot_ts"].replace(tzinfo=timezone.utc) - at(0)).total_seconds()), r["edge"]) for r in df.collect())


def test_edges_of_changes_and_of_snapshots_differ_on_absence(spark):
    states = _states(spark, [(0, 1, 1), (0, 2, 0), (0, 4, 0), (0, 5, -1), (1, 1, 0), (2, 5, 2)])
    assert _edges(H.newly_completed(states, edge="both")) == [
        ("REQ-0", 2, "rising"),
        ("REQ-0", 5, "falling"),
        ("REQ-1", 1, "rising"),
    ]
    # As full snapshots, absence at second 3 (request 0) and at 2 (request 1) ends completeness.
    assert _edges(H.newly_completed(states, edge="both", every="1 second")) == [
        ("REQ-0", 2, "rising"),
        ("REQ-0", 3, "falling"),
        ("REQ-0", 4, "rising"),
        ("REQ-0", 5, "falling"),
        ("REQ-1", 1, "rising"),
        ("REQ-1", 2, "falling"),
    ]
    assert {e for *_, e in _edges(H.newly_completed(states))} == {"rising"}
    assert {e for *_, e in _edges(H.newly_completed(states, edge="falling"))} == {"falling"}
    with pytest.raises(ValueError):
        H.newly_completed(states, edge="sideways")


def test_sliding_window_of_two_seconds(spark):
    data = data_frame(spark, [(0, "T", 0), (0, "T", 1), (0, "M", 1)])
    rows = H.windowed_counts(data).collect()
    counts = {
        int((r["window_start"].replace(tzinfo=timezone.utc) - at(0)).total_seconds()): (r["received_trade_data"], r["received_market_data"])
        for r in rows
    }
    assert counts == {-1: (1, 0), 0: (2, 1), 1: (1, 1)}
