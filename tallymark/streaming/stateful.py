"""Streaming reconciliation with explicit keyed state: once per request, with idle expiry."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..functions import messages as M
from . import processor
from .feed import delivery_feed

# Executors need not have this package installed for the state logic.
cloudpickle.register_pickle_by_value(processor)

# Requests are worked on, stored and timed in so many parts. A part costs as many calls to the
# state store as a single request would; it is read and written whole when one of its requests changes.
PARTS = 1 << 14


def stateful_reconcile(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    ts: str = "ts",
    seq: str | None = None,
    missing: str = "zero",
    ttl: timedelta | None = None,
    delay: str = "5 seconds",
    per_message: bool = False,
    reset_on_complete: bool = False,
    tick: timedelta = timedelta(seconds=1),
) -> DataFrame:
    """COMPLETE once per request, and EXPIRED for one idle for ``ttl`` of event time (append mode).

    With ``missing="quarantine"`` a request whose newest control message lacks a type is not
    complete, and BAD_CTRL instead of EXPIRED.

    By default counts are combined map-side before the shuffle and a request is looked
    at once per micro-batch, so a request that owns a third of the rows sends each task's
    partial counts and nothing more. Requests are dealt by hash into ``PARTS`` parts, whose
    state and timer are kept in one piece. ``per_message`` keeps each request by itself and looks after every message instead;
    that needs all of a request's messages of a micro-batch in one task, so bound the
    micro-batch at the source. ``reset_on_complete`` starts counting afresh after each
    completion instead of announcing it once.

    With ``ttl`` the state of a request goes away once it is idle that long, whether
    it was announced or not; rows later than ``delay`` behind the newest one are late
    and dropped by the watermark. Lateness is that of the ``tick`` a row's time lies in, by
    the tick's beginning: rows of one tick may be combined, and however they are, in whatever
    Arrow batches or message by message, the same ones are late. Without ``ttl`` state is
    kept for good. Start it under ``state_store("rocksdb")``.
    """
    declared = [M.declared_column(t) for t in types]
    received = [M.received_column(t) for t in types]
    # Times travel as numbers: pandas timestamps would pass through the session's time zone.
    # A row without a time is as old as the epoch: late under a watermark, else before all others.
    us = F.coalesce(F.unix_micros("ts"), F.lit(0).cast("bigint"))
    tick_us = int(tick / timedelta(microseconds=1))
    feed = delivery_feed(control, data, keys, types, ts, seq, missing).withColumn("us", us).drop("ts")
    feed = feed.withColumn("tick", F.floor(F.col("us") / tick_us) * tick_us)
    key_names = list(keys)
    if not per_message:

        def combine(batches):
            return processor.combine_batches(batches, key_names, declared, received)

        feed = feed.mapInPandas(combine, feed.schema)
    if ttl is not None:
        feed = feed.withColumn("ts", F.timestamp_micros("tick")).withWatermark("ts", delay)
    ttl_ms = None if ttl is None else int(ttl / timedelta(milliseconds=1))
    key_types = {field.name: field.dataType.simpleString() for field in feed.schema if field.name in key_names}
    if per_message:
        groups = feed.groupBy(*keys)
        subject = processor.DeliveryProcessor(key_names, declared, received, ttl_ms, per_message, reset_on_complete)
    else:
        texts = [F.col(name).cast("string").alias(name) for name in keys]
        message = F.struct(*texts, "seq", "is_control", *declared, *received, "us")
        groups = feed.select(
            F.pmod(F.xxhash64(*keys), F.lit(PARTS)).alias("part"),
            F.to_json(message, {"ignoreNullFields": "false"}).alias("message"),
            *(["ts"] if ttl is not None else []),
        ).groupBy("part")
        subject = processor.PartProcessor(key_names, declared, received, ttl_ms, reset_on_complete)
    output = ", ".join(
        [
            *[f"{name} {key_types[name] if per_message else 'string'}" for name in key_names],
            "status string",
            *[f"{name} bigint" for name in (*declared, *received)],
            "at_us bigint",
        ]
    )
    changes = groups.transformWithState(
        statefulProcessor=subject,
        outputStructType=output,
        outputMode="Append",
        timeMode="None" if ttl is None else "EventTime",
    )
    own = [F.col(name).cast(key_types[name]).alias(name) for name in key_names]
    return changes.select(*own, "status", *declared, *received, F.timestamp_micros("at_us").alias("at"))
