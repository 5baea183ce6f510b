"""Encoding, decoding and quarantine in both wire formats."""

from __future__ import annotations

import json

import pytest
from frames import at, key
from pyspark.sql import functions as F

from tallymark.operators import counting, reconcile as R
from tallymark.sources import codec, protobuf, readers, writers

KEY = json.dumps({"ReqId": "REQ-0", "FOId": "FO-0"}).encode()
CODECS = {
    "json": (codec.JSON_ENCODERS, codec.JSON_DECODERS),
    "protobuf": (protobuf.arrow_encoders(), protobuf.arrow_decoders()),
}


def envelopes(spark, rows):
    return spark.createDataFrame(
        [(bytearray(k) if k is not None else None, bytearray(v) if v is not None else None, "t", at(0)) for k, v in rows],
        "key binary, value binary, topic string, timestamp timestamp",
    )


def control_frame(spark):
    return spark.createDataFrame(
        [(*key(0), "fo-0", {"TRADE_DATA": 3, "MARKET_DATA": 0}, at(1)), ("", "", "", {}, at(2))],
        "req_id string, fo_id string, fo_name string, statistics map<string,bigint>, ts timestamp",
    )


def data_frame(spark):
    return spark.createDataFrame(
        [(*key(0), "MARKET_DATA", "Trade-1", "42", at(1)), (*key(1), "TRADE_DATA", "", "", at(2))],
        "req_id string, fo_id string, type string, id string, value string, ts timestamp",
    )


def as_rows(df):
    return sorted(str(row.asDict()) for row in df.collect())


@pytest.mark.parametrize("name", CODECS)
@pytest.mark.parametrize("kind,frame", [("control", control_frame), ("data", data_frame)])
def test_roundtrip(spark, name, kind, frame):
    encoders, decoders = CODECS[name]
    messages = frame(spark)
    good, bad = codec.quarantine(codec.decode_messages(codec.encode_messages(messages, kind, encoders), kind, decoders))
    assert as_rows(good.select(*messages.columns)) == as_rows(messages)
    assert bad.count() == 0


@pytest.mark.parametrize("name", CODECS)
def test_what_is_no_message_encodes_to_null(spark, name):
    encoders, _ = CODECS[name]
    odd = data_frame(spark).withColumn("type", F.lit("UNRECOGNIZED"))
    assert [r["value"] for r in codec.encode_messages(odd, "data", encoders).collect()] == [None, None]
    huge = control_frame(spark).withColumn("statistics", F.create_map(F.lit("TRADE_DATA"), F.lit(2**31).cast("bigint")))
    written = [r["value"] is not None for r in codec.encode_messages(huge, "control", encoders).collect()]
    assert written == [name == "json"] * 2  # only the binary format has int32 counts
    _, bad = codec.screen_messages(huge, "control", encoders)
    assert [r["error"] for r in bad.collect()] == [] if name == "json" else ["COUNT_TOO_LARGE"] * 2
    with pytest.raises(Exception, match="UNKNOWN_TYPE"):
        codec.encode_messages(odd, "data", encoders, invalid="fail").collect()
    assert all(r["key"] is not None for r in codec.encode_messages(huge, "control", encoders).collect())


def test_json_rejects_carry_reason_and_bytes(spark):
    raw = envelopes(
        spark,
        [
            (KEY, b'{"Type":"TRADE_DATA","Id":"Trade-0","Value":"7"}'),
            (None, b"{}"),
            (b"{", b"{}"),
            (KEY, None),
            (KEY, b'{"Type":'),
            (KEY, b""),
        ],
    )
    good, bad = codec.quarantine(codec.decode_messages(raw, "data"))
    assert [r["id"] for r in good.collect()] == ["Trade-0"]
    reasons = sorted(r["error"] for r in bad.collect())
    assert reasons == ["BAD_KEY", "BAD_VALUE", "BAD_VALUE", "NULL_KEY", "NULL_VALUE"]
    assert {bytes(r["raw_value"]) for r in bad.collect() if r["raw_value"] is not None} == {b"{}", b'{"Type":', b""}


def test_unset_fields_and_unknown_types(spark):
    raw = envelopes(
        spark,
        [(b"{}", b"{}"), (KEY, b'{"Type":"WEATHER_DATA"}'), (KEY, b'{"Type":1}'), (KEY, b'{"Type":9}')],
    )
    rows = codec.decode_messages(raw, "data").collect()
    assert [r["type"] for r in rows] == ["TRADE_DATA", "UNRECOGNIZED", "MARKET_DATA", "UNRECOGNIZED"]
    assert (rows[0]["req_id"], rows[0]["fo_id"], rows[0]["id"], rows[0]["value"]) == ("", "", "", "")
    good, _ = codec.quarantine(codec.decode_messages(raw, "data"))
    counts = {r["req_id"]: (r["received_trade_data"], r["received_market_data"]) for r in counting.type_counts(good).collect()}
    assert counts == {"": (1, 0), "REQ-0": (0, 1)}


def test_control_defaults_and_repeated_map_keys(spark):
    raw = envelopes(
        spark,
        [(KEY, b'{"Statistics":{"TRADE_DATA":1,"TRADE_DATA":2,"MARKET_DATA":null}}'), (KEY, b"{}"), (KEY, b'{"Statistics":{"TRADE_DATA":"x"}}')],
    )
    rows = codec.decode_messages(raw, "control").collect()
    assert rows[0]["statistics"] == {"TRADE_DATA": 2, "MARKET_DATA": 0}
    assert (rows[1]["fo_name"], rows[1]["statistics"]) == ("", {})
    assert (rows[2]["error"], rows[2]["statistics"]) == ("BAD_VALUE", None)


def test_protobuf_bytes_follow_the_wire_format(spark):
    # Field 1 "REQ-0" and field 2 "FO-0" of a key; a data message with type 1 and an unknown field 15.
    raw = envelopes(
        spark,
        [
            (b"\x0a\x05REQ-0\x12\x04FO-0", b"\x08\x01\x12\x07Trade-3\x1a\x0242\x7a\x01z"),
            (b"", b""),
            (b"\x0a\x05REQ-0", b"\x08\x07"),
            (b"\x0a\x09REQ", b"\x08\x01"),
            (b"\x0a\x05REQ-0", b"\x12\x63x"),
        ],
    )
    rows = codec.decode_messages(raw, "data", protobuf.arrow_decoders()).collect()
    assert [r["error"] for r in rows] == [None, None, None, "BAD_KEY", "BAD_VALUE"]
    assert (rows[0]["req_id"], rows[0]["fo_id"], rows[0]["type"], rows[0]["id"], rows[0]["value"]) == (
        "REQ-0", "FO-0", "MARKET_DATA", "Trade-3", "42",
    )
    assert (rows[1]["req_id"], rows[1]["type"], rows[1]["id"]) == ("", "TRADE_DATA", "")
    assert rows[2]["type"] == "UNRECOGNIZED"


def test_custom_decoder(spark):
    """A decoder is any function from bytes to a struct."""
    text = lambda payload: F.when(
        payload.cast("string").contains(":"),
        F.struct(
            F.split(payload.cast("string"), ":")[0].alias("Type"),
            F.split(payload.cast("string"), ":")[1].alias("Id"),
            F.lit("").alias("Value"),
        ),
    )
    decoders = codec.MessageCodec(codec.JSON_DECODERS.key, codec.JSON_DECODERS.control, text)
    rows = codec.decode_messages(envelopes(spark, [(KEY, b"MARKET_DATA:a"), (KEY, b"?")]), "data", decoders).collect()
    assert [(r["type"], r["id"], r["error"]) for r in rows] == [("MARKET_DATA", "a", None), (None, None, "BAD_VALUE")]


@pytest.mark.parametrize("format", ["parquet", "orc", "json"])
def test_file_topics_hold_what_was_written(spark, tmp_path, format):
    folder = str(tmp_path / "ctrl")
    writers.write_messages(codec.encode_messages(control_frame(spark), "control"), "ctrl", format, folder)
    good, bad = codec.quarantine(readers.read_control(spark, format, folder, streaming=False))
    assert as_rows(good) == as_rows(control_frame(spark))
    assert bad.count() == 0


def test_table_layout(spark, tmp_path):
    folder = str(tmp_path / "data")
    data_frame(spark).write.json(folder)
    assert as_rows(readers.read_data(spark, "json", folder, streaming=False, layout="table")) == as_rows(data_frame(spark))
    with pytest.raises(ValueError):
        readers.read_data(spark, "json", folder, layout="heap")


def test_decoded_topic_reconciles(spark):
    control = control_frame(spark).where("req_id <> ''")
    data = data_frame(spark).withColumn("type", F.lit("TRADE_DATA")).where("req_id = 'REQ-0'")
    raw_control = codec.encode_messages(control, "control")
    raw_data = codec.encode_messages(data, "data")
    good_control, _ = codec.quarantine(codec.decode_messages(raw_control, "control"))
    good_data, _ = codec.quarantine(codec.decode_messages(raw_data, "data"))
    assert [r["status"] for r in R.reconcile(good_control, good_data).collect()] == ["INCOMPLETE"]


def test_kafka_options():
    assert readers.kafka_source_options("ctrl") == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "ctrl",
        "startingOffsets": "latest",
    }
    assert readers.kafka_source_options("data", streaming=False)["startingOffsets"] == "earliest"
    options = writers.kafka_sink_options("data", "b:1", writers.UNBATCHED_SINK)
    assert options["kafka.acks"] == "all" and options["kafka.batch.size"] == "10" and options["topic"] == "data"
