"""Small hand-made message frames and file streams."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone

from tallymark.functions import messages as M

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return START + timedelta(seconds=seconds)


def key(n):
    return f"REQ-{n}", f"FO-{n}"


CONTROL_DDL = "req_id string, fo_id string, fo_name string, statistics map<string,bigint>, ts timestamp, seq bigint"
DATA_DDL = "req_id string, fo_id string, type string, id string, value string, ts timestamp, seq bigint"

NAMES = {"T": "TRADE_DATA", "M": "MARKET_DATA", "U": "UNRECOGNIZED"}


def control_frame(spark, rows):
    """Rows of (request, trades, market, seconds[, seq])."""
    out = []
    for n, trades, market, seconds, *seq in rows:
        counts = {"TRADE_DATA": trades, "MARKET_DATA": market}
        statistics = {name: count for name, count in counts.items() if count is not None}
        out.append((*key(n), f"fo-{n}", statistics, at(seconds), seq[0] if seq else 0))
    return spark.createDataFrame(out, CONTROL_DDL)


def data_frame(spark, rows):
    """Rows of (request, type letter, seconds[, seq])."""
    out = [
        (*key(n), NAMES[kind], f"Trade-{i}", "1", at(seconds), rest[0] if rest else i)
        for i, (n, kind, seconds, *rest) in enumerate(rows)
    ]
    return spark.createDataFrame(out, DATA_DDL)


class Topic:
    """A folder of JSON files, one micro-batch each, in an order that does not depend on timing."""

    def __init__(self, folder, schema):
        self.folder, self.schema, self.files = folder, schema, 0
        os.makedirs(folder, exist_ok=True)

    def add(self, rows):
        target = os.path.join(self.folder, f"part-{self.files:05d}.json")
        with open(target, "w") as out:
            out.writelines(json.dumps(row) + "\n" for row in rows)
        stamp = 1_700_000_000 + self.files * 10
        os.utime(target, (stamp, stamp))
        self.files += 1

    def stream(self, spark):
        return spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(self.folder)


def control_topic(folder):
    return Topic(folder, M.CONTROL_SCHEMA)


def data_topic(folder):
    return Topic(folder, M.DATA_SCHEMA)


def control_json(n, trades, market, seconds):
    req, fo = key(n)
    counts = {"TRADE_DATA": trades, "MARKET_DATA": market}
    return {"req_id": req, "fo_id": fo, "fo_name": f"fo-{n}", "statistics": counts, "ts": at(seconds).isoformat()}


def data_json(n, kind, seconds):
    req, fo = key(n)
    return {"req_id": req, "fo_id": fo, "type": NAMES[kind], "id": "Trade-0", "value": "1", "ts": at(seconds).isoformat()}
