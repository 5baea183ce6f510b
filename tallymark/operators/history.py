"""Ordered batch operators: running counts, first completion, edges, sliding windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import counters as C, messages as M
from ..session import frozen
from .counting import declared_counts
from .hotkeys import HOT_ROWS, previous, running
from .reconcile import latest_declared

RISING = "rising"
FALLING = "falling"
EDGES = (RISING, FALLING)


def running_column(type_name: str) -> str:
    return f"running_{M.slug(type_name)}"


def running_counts(
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    order_by: Sequence[str] = ("ts", "seq"),
    types: Sequence[str] = M.TYPES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Every record with its request's counts per type so far, itself included.

    ``order_by`` orders the records of a request without ties: a time column and, where
    times repeat within a request, one or more that tell the records apart.
    """
    sums = {running_column(t): C.type_flag(F.col("type"), t) for t in types}
    return running(data, keys, order_by, sums, hot_rows=hot_rows)


def first_completion(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    ts: str = "ts",
    seq: str = "seq",
    types: Sequence[str] = M.TYPES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """When each request first became complete, checked after every single message.

    Messages are taken in order of time; at equal times control messages come first,
    then ``seq`` decides. A request that is over-delivered later still counts from
    its first complete moment; one never complete does not appear.
    """
    declared_names = [M.declared_column(t) for t in types]
    controls = declared_counts(control, types).select(
        *keys,
        F.col(ts).alias("_ts"),
        F.lit(0).alias("_kind"),
        F.col(seq).cast("bigint").alias("_seq"),
        F.struct(*declared_names).alias("_declared"),
        F.lit(None).cast("string").alias("_type"),
    )
    records = data.select(
        *keys,
        F.col(ts).alias("_ts"),
        F.lit(1).alias("_kind"),
        F.col(seq).cast("bigint").alias("_seq"),
        F.lit(None).cast(controls.schema["_declared"].dataType).alias("_declared"),
        F.col("type").alias("_type"),
    )
    prefix = running(
        controls.unionByName(records),
        keys,
        ("_ts", "_kind", "_seq"),
        {running_column(t): C.type_flag(F.col("_type"), t) for t in types},
        {"_current": F.col("_declared")},
        hot_rows=hot_rows,
    )
    # Comparing an absent control message gives null, which the filter rejects.
    matches = C.all_zero(
        [F.col(f"_current.{M.declared_column(t)}") - F.col(running_column(t)) for t in types]
    )
    first = F.min(F.struct("_ts", "_kind", "_seq", *[running_column(t) for t in types])).alias("_first")
    return (
        prefix.where(matches)
        .groupBy(*keys)
        .agg(first)
        .select(
            *keys,
            F.col("_first._ts").alias("completed_at"),
            *[F.col(f"_first.{running_column(t)}").alias(M.received_column(t)) for t in types],
        )
    )


def state_changes(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    ts: str = "ts",
    every: str = "day",
    types: Sequence[str] = M.TYPES,
    order_by: Sequence[str] = ("ts",),
    hot_rows: int | None = None,
) -> DataFrame:
    """Deltas of each request at the end of every interval in which it received something.

    Records are counted per request and interval first; the running total then goes
    over those counts only, at most one per interval, which is why no search for hot
    requests is made by default. ``snapshot_ts`` is the start of the interval.
    """
    step = F.date_trunc(every, F.col(ts)).cast(data.schema[ts].dataType)
    per_interval = data.groupBy(*keys, step.alias("snapshot_ts")).agg(
        *[C.count_of_type(F.col("type"), t).alias(M.received_column(t)) for t in types]
    )
    so_far = running(
        per_interval,
        keys,
        ("snapshot_ts",),
        {running_column(t): F.col(M.received_column(t)) for t in types},
        hot_rows=hot_rows,
    ).select(*keys, "snapshot_ts", *[F.col(running_column(t)).alias(M.received_column(t)) for t in types])
    declared = latest_declared(control, keys, types, order_by)
    return so_far.join(declared, list(keys)).select(
        *keys,
        "snapshot_ts",
        *[column.alias(M.delta_column(t)) for t, column in C.deltas(types).items()],
    )


def newly_completed(
    history: DataFrame,
    keys: Sequence[str] = M.KEYS,
    ts: str = "snapshot_ts",
    edge: str = "rising",
    every: str | None = None,
    types: Sequence[str] = M.TYPES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Moments at which a request turned complete (rising) or stopped being so (falling).

    Without ``every``, ``history`` holds one row per change of state (see
    ``state_changes``) and a request keeps its state between rows. With ``every``,
    the history is a series of full snapshots that far apart, and a request missing
    from a snapshot is not complete in it: each completed row then votes for its own
    snapshot and for the next, and a single vote in two snapshots is an edge. The
    votes are summed by request and snapshot, so no request's history is gathered.
    """
    if edge not in (*EDGES, "both"):
        raise ValueError(f"edge must be rising, falling or both, not {edge!r}")
    if every is None:
        edges = _edges_of_changes(history, keys, ts, types, hot_rows)
    else:
        edges = _edges_of_snapshots(history, keys, ts, every, types)
    return edges if edge == "both" else edges.where(F.col("edge") == edge)


def _edges_of_changes(
    history: DataFrame, keys: Sequence[str], ts: str, types: Sequence[str], hot_rows: int | None
) -> DataFrame:
    states = history.select(*keys, ts, C.is_complete(types).alias("_now"))
    before = F.coalesce("_before", F.lit(False))
    return (
        previous(states, keys, (ts,), "_now", "_before", hot_rows=hot_rows)
        .where(F.col("_now") != before)
        .select(*keys, ts, F.when(F.col("_now"), F.lit(RISING)).otherwise(F.lit(FALLING)).alias("edge"))
    )


def _edges_of_snapshots(
    history: DataFrame, keys: Sequence[str], ts: str, every: str, types: Sequence[str]
) -> DataFrame:
    # Read twice below, so worked out once: who was complete when, and nothing else.
    states = frozen(history.select(*keys, ts, C.is_complete(types).alias("_complete")), "snapshots")
    horizon = states.agg(F.max(ts).alias("_horizon"))
    votes = F.array(
        F.struct(F.col(ts).alias("at"), F.lit(1).alias("now"), F.lit(0).alias("before")),
        F.struct(
            (F.col(ts) + F.expr(f"INTERVAL {every}")).alias("at"), F.lit(0).alias("now"), F.lit(1).alias("before")
        ),
    )
    tally = (
        states.where("_complete")
        .select(*keys, F.explode(votes).alias("_vote"))
        .groupBy(*keys, F.col("_vote.at").alias(ts))
        .agg(F.sum("_vote.now").alias("_now"), F.sum("_vote.before").alias("_before"))
        .where(F.col("_now") + F.col("_before") == 1)
    )
    # The last snapshot's time is a single value, computed once as a scalar subquery.
    return tally.where(F.col(ts) <= horizon.scalar()).select(
        *keys, ts, F.when(F.col("_now") == 1, F.lit(RISING)).otherwise(F.lit(FALLING)).alias("edge")
    )


def windowed_counts(
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    ts: str = "ts",
    length: str = "2 seconds",
    slide: str | None = "1 second",
    types: Sequence[str] = M.TYPES,
) -> DataFrame:
    """Counts per request, type and sliding window; works on batch and streaming frames alike."""
    return (
        data.groupBy(*keys, F.window(ts, length, slide).alias("_window"))
        .agg(*[C.count_of_type(F.col("type"), t).alias(M.received_column(t)) for t in types])
        .select(
            *keys,
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *[M.received_column(t) for t in types],
        )
    )
