"""Golden message scripts through file streams, one file per micro-batch."""

from __future__ import annotations

from datetime import timedelta

import pytest
from frames import at, control_json, control_topic, data_json, data_topic, key
from pyspark.sql import functions as F

from tallymark.operators import history as H, reconcile as R
from tallymark.sources import writers
from tallymark.streaming import run
from tallymark.streaming.aggregate import aggregate_reconcile, end_states
from tallymark.streaming.snapshot import delivery_snapshot, state_snapshot
from tallymark.streaming.stateful import stateful_reconcile

PROVIDER = {"update": "hdfs", "append": "rocksdb"}


class Script:
    """Control and data topics of one test, and the table its query writes."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.control = control_topic(str(folder / "ctrl"))
        self.data = data_topic(str(folder / "data"))

    def add(self, control=(), data=()):
        """One file for each topic, so both are part of the same micro-batch."""
        self.control.add([control_json(*row) for row in control])
        self.data.add([data_json(*row) for row in data])

    def streams(self):
        return self.control.stream(self.spark), self.data.stream(self.spark)

    def run(self, build, mode, provider=None, checkpoint="ck"):
        with run.state_store(self.spark, provider or PROVIDER[mode]):
            query = run.start_table(
                build(*self.streams()), str(self.folder / "out"), str(self.folder / checkpoint), mode
            )
        assert query.awaitTermination(240)
        return self.written()

    def written(self):
        rows = run.read_changes(self.spark, str(self.folder / "out")).collect()
        return sorted((r["batch_id"], r["req_id"], r["status"]) for r in rows)


@pytest.fixture
def script(spark, tmp_path):
    return Script(spark, tmp_path)


def mixed(script):
    """In order, data first, zero control, and one request that never completes."""
    script.add([(0, 1, 1, 0), (1, 2, 0, 0), (2, 0, 0, 0)], [(0, "T", 1), (3, "M", 1), (1, "T", 1)])
    script.add([], [(0, "M", 2)])
    script.add([], [(0, "T", 3)])
    script.add([(3, 0, 1, 4)], [])


def revised(script):
    script.add([(0, 1, 0, 0)], [(0, "T", 1)])
    script.add([(0, 1, 0, 2)], [])
    script.add([], [(0, "T", 3)])
    script.add([(0, 2, 0, 4)], [])


MIXED = [(0, "REQ-2", "COMPLETE"), (1, "REQ-0", "COMPLETE"), (3, "REQ-3", "COMPLETE")]


def completed_only(build):
    return lambda control, data: R.completed(build(control, data))


def test_mixed_script_aggregate(script):
    mixed(script)
    assert script.run(run.stream_completed, "update") == MIXED


def test_mixed_script_stateful(script):
    mixed(script)
    assert script.run(stateful_reconcile, "append") == MIXED


def test_mixed_script_stateful_per_message(script):
    mixed(script)
    assert script.run(lambda c, d: stateful_reconcile(c, d, per_message=True), "append") == MIXED


def test_revised_control_reemits_status_but_announces_once(script):
    revised(script)
    assert script.run(completed_only(aggregate_reconcile), "update", "rocksdb") == [
        (0, "REQ-0", "COMPLETE"),
        (1, "REQ-0", "COMPLETE"),
        (3, "REQ-0", "COMPLETE"),
    ]


def test_revised_control_announced_once(script):
    revised(script)
    assert script.run(run.stream_completed, "update") == [(0, "REQ-0", "COMPLETE")]


def test_revised_control_announced_once_stateful(script):
    revised(script)
    build = lambda c, d: run.stream_completed(c, d, engine="state")
    assert script.run(build, "append") == [(0, "REQ-0", "COMPLETE")]


def test_reset_on_complete_announces_a_repeated_delivery_again(script):
    script.add([(0, 1, 0, 0)], [(0, "T", 1)])
    script.add([], [(0, "T", 2)])
    build = lambda c, d: stateful_reconcile(c, d, reset_on_complete=True)
    assert script.run(build, "append") == [(0, "REQ-0", "COMPLETE"), (1, "REQ-0", "COMPLETE")]


def test_over_delivery_within_a_micro_batch(script):
    """Looked at once per micro-batch it was never complete; message by message it was."""
    script.add([(0, 1, 0, 0)], [(0, "T", 1), (0, "T", 2)])
    per_message = lambda c, d: stateful_reconcile(c, d, per_message=True)
    assert script.run(per_message, "append") == [(0, "REQ-0", "COMPLETE")]


def test_over_delivery_is_a_status(script):
    script.add([(0, 1, 0, 0)], [(0, "T", 1), (0, "T", 2)])
    assert script.run(aggregate_reconcile, "update") == [(0, "REQ-0", "OVER")]


def test_two_types_of_state_store_agree_on_unknown_types(script):
    script.add([(0, 1, 0, 0)], [(0, "U", 1), (0, "T", 1)])
    assert script.run(aggregate_reconcile, "update", "rocksdb") == [(0, "REQ-0", "COMPLETE")]


def _ttl(control, data):
    return stateful_reconcile(control, data, ttl=timedelta(seconds=20), delay="5 seconds")


def test_expiry_and_restart(script):
    mixed(script)
    assert script.run(_ttl, "append") == MIXED
    # A restart on the same checkpoint; the late clock expires request 1, which never
    # completed, and silently drops the finished ones.
    script.add([], [(9, "T", 60)])
    script.add([], [(9, "T", 61)])
    after = script.run(_ttl, "append")
    assert [row for row in after if row[2] == "EXPIRED"] == [(after[-1][0], "REQ-1", "EXPIRED")]
    assert [row for row in after if row[2] == "COMPLETE"] == MIXED
    live = state_snapshot(script.spark, str(script.folder / "ck"), state_variable="delivery")
    assert [r["req_id"] for r in live.collect()] == ["REQ-9"]


def test_late_data_after_expiry_does_not_complete(script):
    script.add([(0, 1, 0, 0)], [])
    script.add([], [(9, "U", 60)])
    script.add([], [(0, "T", 90), (9, "U", 90)])
    script.add([], [(9, "U", 200)])
    script.add([], [(9, "U", 201)])
    states = [row[1:] for row in script.run(_ttl, "append") if row[1] == "REQ-0"]
    assert states == [("REQ-0", "EXPIRED"), ("REQ-0", "EXPIRED")]


def test_end_states_tell_how_a_request_ended(script):
    mixed(script)
    script.add([], [(9, "T", 60)])
    script.add([], [(9, "T", 61)])
    build = lambda c, d: end_states(c, d, ttl=timedelta(seconds=20), delay="5 seconds")
    assert [row[1:] for row in script.run(build, "append", "rocksdb")] == [
        ("REQ-0", "OVER"),
        ("REQ-1", "INCOMPLETE"),
        ("REQ-2", "COMPLETE"),
        ("REQ-3", "COMPLETE"),
    ]


def test_restart_resumes_counting(script):
    script.add([(0, 2, 0, 0)], [(0, "T", 1)])
    assert script.run(run.stream_completed, "update") == []
    script.add([], [(0, "T", 2)])
    assert script.run(run.stream_completed, "update") == [(1, "REQ-0", "COMPLETE")]


def test_stream_ends_where_batch_does(script):
    mixed(script)
    script.run(aggregate_reconcile, "update", "rocksdb")
    names = ["req_id", "fo_id", "declared_trade_data", "declared_market_data", "received_trade_data", "received_market_data", "status"]
    read = lambda topic: script.spark.read.schema(topic.schema).json(topic.folder)
    batch = R.reconcile(read(script.control), read(script.data)).select(names)
    stream = run.latest_state(script.spark, str(script.folder / "out")).select(names)
    stored = delivery_snapshot(script.spark, str(script.folder / "ck")).select(names)
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stream.collect()))
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, stored.collect()))


def test_snapshot_of_an_earlier_batch(script):
    mixed(script)
    script.run(aggregate_reconcile, "update")
    first = delivery_snapshot(script.spark, str(script.folder / "ck"), batch_id=0)
    assert {r["req_id"]: r["status"] for r in first.collect()} == {
        "REQ-0": "INCOMPLETE",
        "REQ-1": "INCOMPLETE",
        "REQ-2": "COMPLETE",
        "REQ-3": "NO_CTRL",
    }


def test_complete_mode_lists_every_request_each_time(script):
    mixed(script)
    rows = script.run(aggregate_reconcile, "complete", "hdfs")
    assert [row[1] for row in rows if row[0] == 2] == ["REQ-0", "REQ-1", "REQ-2", "REQ-3"]


def test_windowed_counts_on_a_stream(script):
    script.add([], [(0, "T", 0), (0, "T", 1)])
    script.add([], [(0, "M", 30)])
    script.add([], [(0, "M", 31)])
    data = script.data.stream(script.spark).withWatermark("ts", "1 second")
    with run.state_store(script.spark, "rocksdb"):
        query = run.start_table(H.windowed_counts(data), str(script.folder / "out"), str(script.folder / "ck"))
    assert query.awaitTermination(240)
    closed = run.read_changes(script.spark, str(script.folder / "out")).where(F.col("window_start") < F.lit(at(20)))
    assert sorted(r["received_trade_data"] for r in closed.collect()) == [1, 1, 2]


def test_notifier_prints_and_stops(script):
    script.add([(0, 1, 0, 0)], [(0, "T", 1)])
    query = run.start_notifier(*script.streams(), checkpoint=str(script.folder / "ck"), every=None)
    assert query.awaitTermination(240)
    assert query.exception() is None
    assert query.recentProgress[0].sink.numOutputRows == 1


def test_message_sink_as_a_stream(script):
    from tallymark.sources import codec

    script.add([(0, 1, 0, 0)], [(0, "T", 1)])
    encoded = codec.encode_messages(script.data.stream(script.spark), codec.DATA)
    out = str(script.folder / "topic")
    query = writers.write_messages(encoded, "data", "parquet", out, checkpoint=str(script.folder / "ck2"))
    assert query.awaitTermination(240)
    decoded = codec.decode_messages(script.spark.read.parquet(out), codec.DATA).collect()
    assert [(r["req_id"], r["fo_id"], r["type"]) for r in decoded] == [(*key(0), "TRADE_DATA")]


def test_state_store_setting_is_restored(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with run.state_store(spark, "rocksdb"):
        assert spark.conf.get(name).endswith("RocksDBStateStoreProvider")
    assert spark.conf.get(name, None) == before
