"""The protobuf wire format, as codecs for ``decode_messages`` and ``encode_messages``.

Two ways in, same columns out. ``jvm_*`` uses Spark's protobuf connector and stays
inside the JVM; it needs the connector jar on the cluster. ``arrow_*`` needs only
the ``protobuf`` Python package on the executors and moves Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

from . import protobuf_wire as wire
from ..functions.messages import TYPES
from .codec import CONTROL_FIELDS, DATA_FIELDS, KEY_FIELDS, MAX_WIRE_COUNT, MessageCodec

# Executors need not have this package installed for the two small helpers.
cloudpickle.register_pickle_by_value(wire)


# Functions of one array, not of an iterator of them: Spark hands such of a row's to one Python
# process, so that a task has one for key and value and not one for each.
def _arrow_decoder(message: str, schema: str) -> Callable[[Column], Column]:
    def decode(batch: pa.Array) -> pa.Array:
        return wire.decode_batch(message, batch)

    return lambda payload: F.arrow_udf(decode, schema)(payload)


def _arrow_encoder(message: str) -> Callable[[Column], Column]:
    def encode(batch: pa.Array) -> pa.Array:
        return wire.encode_batch(message, batch)

    return lambda body: F.arrow_udf(encode, "binary")(body)


def arrow_decoders() -> MessageCodec:
    return MessageCodec(
        _arrow_decoder("MsgId", KEY_FIELDS),
        _arrow_decoder("CtrlMsg", CONTROL_FIELDS),
        _arrow_decoder("DataMsg", DATA_FIELDS),
    )


def arrow_encoders() -> MessageCodec:
    return MessageCodec(
        _arrow_encoder("MsgId"), _arrow_encoder("CtrlMsg"), _arrow_encoder("DataMsg"), MAX_WIRE_COUNT, TYPES
    )


def _jvm_decoder(message: str) -> Callable[[Column], Column]:
    from pyspark.sql.protobuf.functions import from_protobuf

    descriptors = wire.descriptor_set()
    return lambda payload: from_protobuf(
        payload,
        f"{wire.PACKAGE}.{message}",
        options={"mode": "PERMISSIVE", "emit.default.values": "true"},
        binaryDescriptorSet=descriptors,
    )


def _jvm_encoder(message: str) -> Callable[[Column], Column]:
    from pyspark.sql.protobuf.functions import to_protobuf

    descriptors = wire.descriptor_set()
    return lambda body: to_protobuf(body, f"{wire.PACKAGE}.{message}", binaryDescriptorSet=descriptors)


def jvm_decoders() -> MessageCodec:
    return MessageCodec(_jvm_decoder("MsgId"), _jvm_decoder("CtrlMsg"), _jvm_decoder("DataMsg"))


def jvm_encoders() -> MessageCodec:
    control = _jvm_encoder("CtrlMsg")

    def narrowed(body: Column) -> Column:
        # The connector wants the map's values to have the message's own width.
        statistics = body["Statistics"].try_cast("map<string,int>")
        return control(F.struct(body["FOName"].alias("FOName"), statistics.alias("Statistics")))

    return MessageCodec(_jvm_encoder("MsgId"), narrowed, _jvm_encoder("DataMsg"), MAX_WIRE_COUNT, TYPES)
