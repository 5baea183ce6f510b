"""Starting streaming queries and reading what they wrote."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import messages as M
from ..operators.reconcile import completed, notifications
from ..sources.writers import write_console
from .aggregate import aggregate_completed, aggregate_reconcile, completed_once
from .stateful import stateful_reconcile

_PROVIDER_SETTING = "spark.sql.streaming.stateStore.providerClass"
_STATE_PACKAGE = "org.apache.spark.sql.execution.streaming.state"
# RocksDB keeps state on disk; with a changelog a commit uploads what changed, not the whole store.
PROVIDERS = {
    "hdfs": {_PROVIDER_SETTING: f"{_STATE_PACKAGE}.HDFSBackedStateStoreProvider"},
    "rocksdb": {
        _PROVIDER_SETTING: f"{_STATE_PACKAGE}.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    },
}


# Merges the sessions of a request within each task before they are shuffled.
LOCAL_SESSIONS = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def state_store(spark: SparkSession, provider: str):
    """Queries started inside use the provider; the session's own settings come back after.

    A query reads the settings once, when it starts, and keeps the provider in its checkpoint.
    """
    return _settings(spark, PROVIDERS[provider])


def local_sessions(spark: SparkSession, provider: str = "rocksdb"):
    """As ``state_store``, for queries with session windows: sessions are merged before the shuffle too.

    Queries of two stateful steps in a row need the provider "hdfs".
    """
    return _settings(spark, {**PROVIDERS[provider], **LOCAL_SESSIONS})


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stream_reconcile(control: DataFrame, data: DataFrame, ttl: timedelta | None = None, **settings) -> DataFrame:
    """Streaming reconciliation: current status per request, or with ``ttl`` its two end states.

    Without ``ttl`` this is ``aggregate_reconcile`` (update or complete mode), with it
    ``stateful_reconcile`` (append mode).
    """
    if ttl is None:
        return aggregate_reconcile(control, data, **settings)
    return stateful_reconcile(control, data, ttl=ttl, **settings)


def stream_completed(control: DataFrame, data: DataFrame, engine: str = "aggregate", **settings) -> DataFrame:
    """Each completed request once: ``aggregate`` runs in the JVM (update mode, state in
    executor memory), ``state`` keeps its state on disk in RocksDB (append mode)."""
    if engine == "aggregate":
        return aggregate_completed(control, data, **settings)
    if engine == "state":
        return completed(stateful_reconcile(control, data, **settings))
    raise ValueError(f"engine must be aggregate or state, not {engine!r}")


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def start_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "append",
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch as one ``batch_id`` partition of a parquet table.

    A micro-batch that runs again after a failure replaces its own partition, so the
    table holds every change exactly once in any output mode. Without ``every`` the
    query takes what is available and stops.
    """

    def replace_partition(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.foreachBatch(replace_partition).trigger(**_trigger(every)).start()


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """Everything ``start_table`` wrote, with the micro-batch it came from."""
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def latest_state(spark: SparkSession, path: str, keys: Sequence[str] = M.KEYS) -> DataFrame:
    """The last row an update-mode query wrote for each request."""
    changes = read_changes(spark, path)
    rest = [name for name in changes.columns if name not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*rest), "batch_id").alias("_last")
    return changes.groupBy(*keys).agg(last).select(*keys, *[f"_last.{name}" for name in rest])


def start_notifier(
    control: DataFrame,
    data: DataFrame,
    checkpoint: str,
    ttl: timedelta | None = timedelta(seconds=20),
    every: str | None = "1 second",
    rows: int = 10,
    output: str | None = None,
    engine: str = "state",
    **settings,
) -> StreamingQuery:
    """The whole consumer: reconcile two streams and give a notice per completed request.

    ``engine="state"`` tells of a completion at once, with a Python step per changed request;
    ``"sessions"`` tells of it once the request has been idle for ``ttl``, in the JVM alone.
    With ``output`` every notice is written to the table there (see ``start_table``);
    without it the first ``rows`` of each micro-batch are printed and the others are not
    kept anywhere.
    """
    spark = control.sparkSession
    if engine not in ("state", "sessions"):
        raise ValueError(f"engine must be state or sessions, not {engine!r}")
    if engine == "sessions" and ttl is None:
        raise ValueError("sessions end after an idle time: give a ttl")
    with state_store(spark, "rocksdb") if engine == "state" else local_sessions(spark, "hdfs"):
        reconcile = stateful_reconcile if engine == "state" else completed_once
        changes = reconcile(control, data, ttl=ttl, **settings)
        notices = notifications(completed(changes), settings.get("keys", M.KEYS))
        if output:
            return start_table(notices, output, checkpoint, every=every)
        return write_console(notices.select("message"), rows, every, checkpoint)
