"""The Arrow codec: a Python process of a task for each way, and few rows as objects at once."""

from __future__ import annotations

import pyarrow as pa
import pytest

pytest.importorskip("google.protobuf")

from tallymark.plans import events  # noqa: E402
from tallymark.sources import protobuf_wire as wire  # noqa: E402


def test_key_and_value_share_a_python_process(spark, small_dir):
    plan = events.decode_protobuf(spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2


def test_long_batches_are_converted_in_pieces():
    rows = [None if n % 5 == 0 else {"ReqId": f"REQ-{n}", "FOId": f"FO-{n}"} for n in range(2 * wire.SLICE_ROWS + 7)]
    kind = pa.struct([("ReqId", pa.string()), ("FOId", pa.string())])
    encoded = wire.encode_batch("MsgId", pa.array(rows, kind))
    assert wire.decode_batch("MsgId", encoded).to_pylist() == rows
    assert wire.decode_batch("MsgId", pa.array([b"\xff", None])).to_pylist() == [None, None]
    assert len(wire.encode_batch("MsgId", pa.array([], kind))) == 0
