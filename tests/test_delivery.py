"""Whole jobs: publish a delivery to file topics, consume it as a stream."""

from __future__ import annotations

import pytest
from frames import control_frame, data_frame
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallymark.operators import reconcile as R
from tallymark.plans import delivery
from tallymark.sources import codec, readers
from tallymark.streaming.run import read_changes


@pytest.mark.parametrize("wire", ["json", "protobuf-arrow"])
def test_published_delivery_is_complete_and_announced(spark, tmp_path, wire):
    encoders, decoders = delivery.codecs(wire)
    data = data_frame(spark, [(0, "T", 1), (0, "M", 2), (1, "T", 3)]).drop("seq")
    topics = str(tmp_path / "topics")
    delivery.publish_delivery(data, F.lit("fo-0"), "parquet", topics, encoders=encoders)

    control, _ = codec.quarantine(readers.read_control(spark, "parquet", f"{topics}/ctrl", False, decoders=decoders))
    records, _ = codec.quarantine(readers.read_data(spark, "parquet", f"{topics}/data", False, decoders=decoders))
    assert {r["status"] for r in R.reconcile(control, records).collect()} == {"COMPLETE"}

    query = delivery.consume(
        spark, str(tmp_path / "ck"), "parquet", topics, decoders=decoders, every=None, options={"maxFilesPerTrigger": "100"}
    )
    assert query.awaitTermination(240)
    assert query.exception() is None
    assert sum(p.sink.numOutputRows for p in query.recentProgress) == 2


def statuses(spark, topics):
    good = [codec.quarantine(delivery.read_delivered(spark, topics, kind))[0] for kind in (codec.CONTROL, codec.DATA)]
    return sorted((r["req_id"], r["received_trade_data"], r["status"]) for r in R.reconcile(*good).collect())


def test_a_delivery_counts_once_however_often_it_is_published(spark, tmp_path, monkeypatch):
    topics = str(tmp_path / "topics")
    data = data_frame(spark, [(0, "T", 1), (0, "T", 2), (1, "T", 3)]).drop("seq")

    def publish(delivery_id="a/b=c"):
        delivery.publish_delivery(data, F.lit("fo-0"), "parquet", topics, delivery_id=delivery_id)

    # The run dies between the two topics.
    real, written = delivery.write_messages, []

    def dies(*args, **kwargs):
        if written:
            raise RuntimeError("lost")
        written.append(real(*args, **kwargs))

    monkeypatch.setattr(delivery, "write_messages", dies)
    with pytest.raises(RuntimeError, match="lost"):
        publish()
    monkeypatch.setattr(delivery, "write_messages", real)
    publish()
    publish()
    assert statuses(spark, topics) == [("REQ-0", 2, "COMPLETE"), ("REQ-1", 1, "COMPLETE")]
    assert delivery._deliveries(spark, topics).count() == 1

    # Two runs of one delivery that did not see each other: one of them counts.
    monkeypatch.setattr(delivery, "_deliveries", lambda spark, path: spark.createDataFrame([], "delivery string, attempt string"))
    publish()
    monkeypatch.undo()
    assert spark.read.parquet(f"{topics}/deliveries").count() == 2
    assert statuses(spark, topics) == [("REQ-0", 2, "COMPLETE"), ("REQ-1", 1, "COMPLETE")]


def test_nothing_is_read_before_the_first_delivery_is_complete(spark, tmp_path):
    topics = str(tmp_path / "topics")
    assert delivery._deliveries(spark, topics).isEmpty()
    with pytest.raises(ValueError, match="Kafka"):
        delivery.publish_delivery(data_frame(spark, [(0, "T", 1)]), F.lit("fo-0"), delivery_id="x")


def test_unknown_wire_format():
    with pytest.raises(ValueError, match="wire format"):
        delivery.codecs("xml")


def test_kafka_needs_its_connector(spark):
    """Without the connector jar the failure is Spark's own, naming the missing source."""
    with pytest.raises(AnalysisException, match="kafka"):
        readers.read_control(spark)


def test_all_notices_and_rejects_are_kept(spark, tmp_path):
    """25 completions in a micro-batch, three types, records of a fourth, a damaged envelope."""
    types = ("TRADE_DATA", "MARKET_DATA", "FX_DATA")
    data = data_frame(spark, [(n, "T", 1) for n in range(25)]).drop("seq")
    data = data.union(data.withColumn("type", F.lit("FX_DATA"))).union(data.withColumn("type", F.lit("ODD")))
    topics, rejects = str(tmp_path / "topics"), str(tmp_path / "unsent")
    for _ in range(2):  # again, as after a failure
        delivery.publish_delivery(
            data, F.lit("fo-0"), "parquet", topics, types=types, rejects=rejects, mode="overwrite"
        )
    assert spark.read.parquet(f"{rejects}/data").groupBy("error").count().collect()[0].asDict() == {
        "error": "UNKNOWN_TYPE",
        "count": 25,
    }
    damaged = spark.read.parquet(f"{topics}/data").limit(1).withColumn("value", F.lit("{").cast("binary"))
    damaged.write.mode("append").parquet(f"{topics}/data")

    output = str(tmp_path / "out")
    queries = delivery.consume_to_tables(
        spark, str(tmp_path / "ck"), output, "parquet", topics, ttl=None, every=None, types=types,
        options={"maxFilesPerTrigger": "100"},
    )
    for query in queries:
        assert query.awaitTermination(240)
        assert query.exception() is None
    notices = read_changes(spark, f"{output}/notices")
    assert notices.select("req_id").distinct().count() == notices.count() == 25
    assert [(r["topic"], r["error"]) for r in read_changes(spark, f"{output}/rejects").collect()] == [("data", "BAD_VALUE")]


@pytest.mark.parametrize("engine", ["state", "sessions"])
def test_announcements_that_lack_a_type_are_rejects(spark, tmp_path, engine):
    """Request 0 is announced whole, request 1 without a count of market data, which it has none of either."""
    control = control_frame(spark, [(0, 1, 0, 0), (1, 1, None, 0), (9, 5, 5, 500)]).drop("seq")
    data = data_frame(spark, [(0, "T", 1), (1, "T", 1), (9, "T", 500)]).drop("seq")
    topics, output = str(tmp_path / "topics"), str(tmp_path / "out")
    for kind, frame in ((codec.CONTROL, control), (codec.DATA, data)):
        codec.encode_messages(frame, kind).coalesce(1).write.parquet(f"{topics}/{codec.TOPICS[kind]}")
    queries = delivery.consume_to_tables(
        spark, str(tmp_path / "ck"), output, "parquet", topics, every=None, missing="quarantine", engine=engine,
        options={"maxFilesPerTrigger": "100"},
    )
    for query in queries:
        assert query.awaitTermination(240) and query.exception() is None
    assert [r["req_id"] for r in read_changes(spark, f"{output}/notices").collect()] == ["REQ-0"]
    rejects = read_changes(spark, f"{output}/rejects").collect()
    assert [(r["topic"], r["error"]) for r in rejects] == [("ctrl", "MISSING_TYPE:MARKET_DATA")]
    assert b"REQ-1" in bytes(rejects[0]["raw_key"])


def test_publishing_what_cannot_be_encoded_fails_without_a_place_for_it(spark, tmp_path):
    data = data_frame(spark, [(0, "T", 1)]).drop("seq").withColumn("type", F.lit("ODD"))
    with pytest.raises(Exception, match="UNKNOWN_TYPE"):
        delivery.publish_delivery(data, F.lit("fo-0"), "parquet", str(tmp_path / "topics"))
