"""Streaming reconciliation as keyed aggregations, entirely inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions import counters as C, messages as M
from ..operators.reconcile import completed
from .feed import delivery_feed


def _counted(feed: DataFrame, groups: Sequence, types: Sequence[str], seq: str | None) -> DataFrame:
    """Newest declaration and received totals per group, in one aggregation."""
    # A control message without a time is older than any other.
    time = F.coalesce("ts", F.lit("0001-01-01").cast("timestamp"))
    when = time if seq is None else F.struct(time.alias("ts"), "seq")
    newest = F.when(F.col("is_control"), when)
    return feed.groupBy(*groups).agg(
        *[F.max_by(M.declared_column(t), newest).alias(M.declared_column(t)) for t in types],
        *[F.sum(M.received_column(t)).alias(M.received_column(t)) for t in types],
        F.count(F.when(F.col("is_control"), F.lit(1))).alias("n_control"),
        F.count(F.when(~F.col("is_control"), F.lit(1))).alias("n_data"),
        F.max("ts").alias("last_ts"),
    )


def with_status(counted: DataFrame, keys: Sequence[str], types: Sequence[str], also: Sequence = ()) -> DataFrame:
    """Counted groups with the status their counts amount to; ``also`` are columns to keep besides."""
    has_control = F.col("n_control") > 0
    has_data = F.col("n_data") > 0
    return counted.select(
        *keys,
        *also,
        *[C.or_zero(F.col(M.declared_column(t))).alias(M.declared_column(t)) for t in types],
        *[M.received_column(t) for t in types],
        has_control.alias("has_control"),
        has_data.alias("has_data"),
        "last_ts",
        C.delivery_status(has_control, has_data, types).alias("status"),
    )


def aggregate_reconcile(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    ts: str = "ts",
    seq: str | None = None,
    missing: str = "zero",
) -> DataFrame:
    """Current counts and status of every request, updated each micro-batch.

    Run it in update mode for requests that changed or in complete mode for a
    snapshot of all. The work of a micro-batch follows the number of changed
    requests, counts are combined map-side before the one shuffle, and the state holds
    one row per request for as long as the query lives (``stateful`` bounds it).
    """
    feed = delivery_feed(control, data, keys, types, ts, seq, missing)
    return with_status(_counted(feed, keys, types, seq), keys, types)


def aggregate_completed(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    ts: str = "ts",
    seq: str | None = None,
    missing: str = "zero",
) -> DataFrame:
    """Each request once, in the micro-batch at whose end it is complete (update mode).

    Two stateful steps in a row: start it under ``state_store("hdfs")``.
    """
    return completed(aggregate_reconcile(control, data, keys, types, ts, seq, missing)).dropDuplicates(list(keys))


def end_states(
    control: DataFrame,
    data: DataFrame,
    ttl: timedelta,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    ts: str = "ts",
    seq: str | None = None,
    missing: str = "zero",
    delay: str = "5 seconds",
) -> DataFrame:
    """Final counts and status of each request once it has been idle for ``ttl`` (append mode).

    A request's messages with no gap of ``ttl`` between them are one session window, and
    Spark drops its state when the watermark passes the window's end. Nothing is told
    before that; ``stateful_reconcile`` announces completion at once. A status other
    than COMPLETE means the request expired in that state. Spark sets the window to
    end ``ttl`` after the last message.
    """
    return with_status(_sessions(control, data, ttl, keys, types, ts, seq, missing, delay), keys, types)


def _sessions(control, data, ttl, keys, types, ts, seq, missing, delay) -> DataFrame:
    feed = delivery_feed(control, data, keys, types, ts, seq, missing).withWatermark("ts", delay)
    gap = f"{int(ttl / timedelta(milliseconds=1))} milliseconds"
    return _counted(feed, [*keys, F.session_window("ts", gap)], types, seq)


def expiry(
    control: DataFrame,
    data: DataFrame,
    ttl: timedelta,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    ts: str = "ts",
    seq: str | None = None,
    missing: str = "zero",
    delay: str = "5 seconds",
) -> DataFrame:
    """COMPLETE or EXPIRED for each request, told once it has been idle for ``ttl`` (append mode).

    The two end states of ``stateful_reconcile`` without Python. Start it under
    ``local_sessions``: a request's messages are then merged within each task before
    the shuffle, so one that owns a third of the rows sends a few sessions a task.
    """
    ended = end_states(control, data, ttl, keys, types, ts, seq, missing, delay)
    status = F.when(F.col("status") == C.COMPLETE, F.lit(C.COMPLETE)).otherwise(F.lit(C.EXPIRED))
    return ended.withColumn("status", status)


def completed_once(
    control: DataFrame,
    data: DataFrame,
    ttl: timedelta,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    ts: str = "ts",
    seq: str | None = None,
    missing: str = "zero",
    delay: str = "5 seconds",
) -> DataFrame:
    """Each completed request once, with both of its states dropped by the watermark (append mode).

    Counts are those of a session, told and dropped once it has been idle for ``ttl``. A
    request complete again in a session that ends within ``delay`` of the first is
    not told again; what remembers it is dropped after that. ``completed_at`` is the
    time of the last message. Two stateful steps in a row: start it under
    ``local_sessions(spark, "hdfs")``.
    """
    sessions = _sessions(control, data, ttl, keys, types, ts, seq, missing, delay)
    told = with_status(sessions, keys, types, also=[F.window_time("session_window").alias("_told")])
    once = completed(told).dropDuplicatesWithinWatermark(list(keys))
    return once.withColumnRenamed("last_ts", "completed_at").drop("_told")
