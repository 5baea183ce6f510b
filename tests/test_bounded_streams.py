"""Streams whose state the watermark bounds, what they tell of late rows, and their history."""

from __future__ import annotations

from collections import Counter
from datetime import timedelta

import pytest
from frames import at, control_json, data_json, key
from pyspark.sql import functions as F
from test_streams import Script

from tallymark.operators import history as H
from tallymark.streaming import late, run
from tallymark.streaming.aggregate import aggregate_reconcile, completed_once, expiry
from tallymark.streaming.edges import stream_edges
from tallymark.streaming.snapshot import delivery_history, delivery_snapshot
from tallymark.streaming.stateful import stateful_reconcile

TTL = timedelta(seconds=20)


@pytest.fixture
def script(spark, tmp_path):
    return Script(spark, tmp_path)


def with_late_rows(script):
    """Request 0 gets its only trade late, in one file with rows in time; request 1 gets a late announcement."""
    script.add([(0, 1, 0, 100), (1, 0, 1, 100)], [(9, "U", 120)])
    # Spark drops what is behind the watermark of the micro-batch before.
    script.add([], [(8, "U", 120)])
    script.add([(1, 0, 0, 50)], [(0, "T", 60), (0, "U", 121), (0, "U", 122), (1, "M", 121), (8, "U", 130)])
    script.add([], [(0, "T", 131), (8, "U", 131)])
    script.add([], [(9, "U", 300)])
    script.add([], [(9, "U", 301)])


@pytest.mark.parametrize("batch", [1, 10, 10_000])
@pytest.mark.parametrize("per_message", [False, True])
def test_lateness_does_not_depend_on_how_rows_are_combined(spark, script, batch, per_message):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(batch))
    try:
        with_late_rows(script)
        build = lambda c, d: stateful_reconcile(c, d, ttl=TTL, delay="5 seconds", per_message=per_message)
        found = [row for row in script.run(build, "append") if row[1] in ("REQ-0", "REQ-1")]
    finally:
        spark.conf.set(name, before)
    assert found == [(2, "REQ-1", "COMPLETE"), (3, "REQ-0", "COMPLETE")]


def ended(script):
    script.add([(0, 1, 0, 0), (1, 2, 0, 0)], [(0, "T", 1), (1, "T", 2)])
    script.add([], [(2, "T", 30)])
    script.add([(2, 1, 0, 60)], [(3, "M", 61)])
    script.add([], [(9, "U", 200)])
    script.add([], [(9, "U", 201)])


def test_expiry_in_sessions(script):
    ended(script)
    with run.local_sessions(script.spark):
        found = script.run(lambda c, d: expiry(c, d, ttl=TTL, delay="5 seconds"), "append")
    # Request 2's trade expired before it was announced.
    assert Counter(row[1:] for row in found) == Counter(
        [("REQ-0", "COMPLETE"), ("REQ-1", "EXPIRED"), ("REQ-2", "EXPIRED"), ("REQ-2", "EXPIRED"), ("REQ-3", "EXPIRED")]
    )


def test_sessions_are_merged_before_the_shuffle(script):
    ended(script)
    with run.local_sessions(script.spark):
        query = run.start_table(
            expiry(*script.streams(), ttl=TTL, delay="5 seconds"), str(script.folder / "out"), str(script.folder / "ck")
        )
    assert query.awaitTermination(240)
    plan = query._jsq.explainInternal(False)
    physical = plan[plan.index("Physical Plan") :] if "Physical Plan" in plan else plan
    lines = [line for line in physical.splitlines() if "MergingSessions" in line or "Exchange hashpartitioning" in line]
    shuffle = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("MergingSessions" in line for line in lines[:shuffle])
    assert any("MergingSessions" in line for line in lines[shuffle + 1 :])
    assert "Python" not in physical and "InPandas" not in physical


def test_completed_once_and_forgotten(script):
    """Twenty requests complete one after the other; two of them again. What remembers them goes."""
    for n in range(20):
        again = [(0, 1, 0, 24)] if n == 1 else []
        script.add([(n, 1, 0, 40 * n), *again], [(n, "T", 40 * n + 1), *[(r, "T", 25) for r, *_ in again]])
    script.add([], [(99, "U", 2000)])
    script.add([], [(99, "U", 2001)])
    with run.local_sessions(script.spark, "hdfs"):
        build = completed_once(*script.streams(), ttl=TTL, delay="30 seconds")
        query = run.start_table(build, str(script.folder / "out"), str(script.folder / "ck"))
    assert query.awaitTermination(240)
    told = run.read_changes(script.spark, str(script.folder / "out"))
    assert Counter(r["req_id"] for r in told.collect()) == Counter(f"REQ-{n}" for n in range(20))
    assert set(told.columns) >= {"req_id", "fo_id", "completed_at", "status"}
    states = [operator["numRowsTotal"] for operator in query.lastProgress["stateOperators"]]
    assert sum(states) < 20


def history_frame(spark, days):
    """Rows of (request, day, complete)."""
    rows = [(f"REQ-{n}", f"FO-{n}", at(86_400 * day), 0 if done else 1, 0) for n, day, done in days]
    return spark.createDataFrame(rows, "req_id string, fo_id string, snapshot_ts timestamp, delta_trade_data bigint, delta_market_data bigint")


def test_edges_of_a_stream_equal_those_of_the_series(spark, tmp_path):
    days = [(0, 0, True), (0, 1, True), (0, 3, True), (1, 1, False), (1, 2, True), (1, 4, True), (2, 0, False), (3, 5, True), (4, 5, False)]
    folder = str(tmp_path / "history")
    for day in range(6):
        history_frame(spark, [d for d in days if d[1] == day] or [(9, day, False)]).coalesce(1).write.mode("append").parquet(folder)
    whole = spark.read.parquet(folder)
    # One more snapshot, in which nobody is complete, lets the last pair be told.
    history_frame(spark, [(9, 6, False)]).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    with run.state_store(spark, "hdfs"):
        query = run.start_table(stream_edges(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert query.awaitTermination(240)
    found = run.read_changes(spark, str(tmp_path / "out")).drop("batch_id")
    want = H.newly_completed(history_frame(spark, days), edge="both", every="1 day")
    assert Counter(map(tuple, found.select(*want.columns).collect())) == Counter(map(tuple, want.collect()))
    assert want.count() > 5


def test_history_of_the_state(script):
    script.add([(0, 1, 1, 0), (1, 2, 0, 0)], [(0, "T", 1), (3, "M", 1)])
    script.add([], [(0, "M", 2)])
    script.add([(3, 0, 1, 4)], [(0, "T", 3), (1, "U", 3)])
    script.run(aggregate_reconcile, "update")
    checkpoint = str(script.folder / "ck")
    history = delivery_history(script.spark, checkpoint)
    assert sorted((r["batch_id"], r["req_id"], r["status"]) for r in history.collect()) == script.written()
    # The newest row of each request up to a batch is the snapshot after that batch.
    for batch in range(3):
        snapshot = delivery_snapshot(script.spark, checkpoint, batch_id=batch)
        so_far = delivery_history(script.spark, checkpoint, last_batch=batch)
        rest = [name for name in snapshot.columns if name != "req_id"]
        newest = so_far.groupBy("req_id").agg(F.max_by(F.struct(*rest), "batch_id").alias("s")).select("req_id", "s.*")
        assert sorted(map(str, newest.select(*snapshot.columns).collect())) == sorted(map(str, snapshot.collect()))


def test_late_rows_are_told_and_none_is_lost(script):
    with_late_rows(script)
    path, checkpoint = str(script.folder / "judged"), str(script.folder / "ck")

    def take():
        query = late.start_late_table(script.data.stream(script.spark), path, checkpoint, delay=timedelta(seconds=5))
        assert query.awaitTermination(240)

    take()
    script.data.add([data_json(5, "T", 200), data_json(5, "T", 296), data_json(5, "T", 297)])
    take()  # a restart remembers how far time has come
    rows = late.read_judged(script.spark, path).collect()
    assert len(rows) == 14
    assert sorted((r["req_id"], r["late_by_us"] // 1_000_000) for r in rows if r["late_by_us"] is not None) == [
        ("REQ-0", 55), ("REQ-5", 0), ("REQ-5", 96)
    ]


def test_rows_without_time_are_in_time(spark):
    rows = spark.createDataFrame([(None,), (at(10),)], "ts timestamp")
    behind = late.lateness(F.col("ts"), F.lit(at(100)), timedelta(seconds=5))
    assert {r[0] for r in rows.select(behind).collect()} == {None, 85_000_000}


def test_keys_of_the_scripts():
    assert control_json(1, 1, 1, 0)["req_id"] == key(1)[0]
