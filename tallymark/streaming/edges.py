"""Edges of completeness in a stream of snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import counters as C, messages as M
from ..operators.history import FALLING, RISING


def stream_edges(
    history: DataFrame,
    keys: Sequence[str] = M.KEYS,
    ts: str = "snapshot_ts",
    every: str = "1 day",
    types: Sequence[str] = M.TYPES,
    delay: str = "0 seconds",
) -> DataFrame:
    """Snapshots in which a request turned complete (rising) or was so no more (falling) (append mode).

    ``history`` is a stream of full snapshots ``every`` so long, in which a request that is
    missing is not complete. A first window holds who was complete in each snapshot;
    a second, two snapshots long, slides over them: a request found once in it crosses an
    edge at its second snapshot. Both are dropped by the watermark; a pair is told
    when the watermark reaches the end of its second snapshot, so what comes after the newest
    snapshot waits for the next one. Two stateful steps in a row: start it under
    ``state_store("hdfs")``.
    """
    # Reading the time keeps the filter above the watermark, which incomplete rows move on too.
    complete = F.when(F.col(ts).isNotNull(), C.is_complete(types))
    shots = (
        history.withWatermark(ts, delay)
        .where(complete)
        .groupBy(*keys, F.window(ts, every).alias("_shot"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, F.window_time("_shot").alias("_at"))
    )
    pair = F.window("_at", _doubled(every), every).alias("_pair")
    pairs = shots.groupBy(*keys, pair).agg(F.count(F.lit(1)).alias("_n"), F.max("_at").alias("_last"))
    second = F.col("_pair.start") + F.expr(f"INTERVAL {every}")
    return pairs.where("_n = 1").select(
        *keys,
        second.alias(ts),
        F.when(F.col("_last") >= second, F.lit(RISING)).otherwise(F.lit(FALLING)).alias("edge"),
    )


def _doubled(every: str) -> str:
    """Twice a length of a number and a unit."""
    number, unit = every.split()
    return f"{2 * int(number)} {unit}"
