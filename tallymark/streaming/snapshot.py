"""Reading the keyed state a streaming query keeps in its checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import messages as M
from .aggregate import with_status


def state_snapshot(
    spark: SparkSession,
    checkpoint: str,
    operator_id: int = 0,
    state_variable: str | None = None,
    batch_id: int | None = None,
) -> DataFrame:
    """Every live request with its state as of a committed micro-batch (the last by default).

    ``state_variable="delivery"`` reads the state of ``stateful_reconcile``; leave it out
    for an aggregation. An aggregation stores several fields under one name; the second
    one named ``sum`` comes out as ``sum_2``, and so on.
    """
    # The reader asks the session's streaming manager where live state sits; this
    # makes sure there is one even before the session's first streaming query.
    spark.streams
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if state_variable:
        reader = reader.option("stateVarName", state_variable)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    stored = reader.load(checkpoint)
    if "list_element" in stored.columns:  # a part's requests, each with its key
        return stored.select("list_element.*")
    # Expanding value.* resolves by name and would read the first of several fields
    # of one name for all of them, so names are made unique by position first.
    value = F.col("value").cast(_unique_names(stored.schema["value"].dataType))
    return stored.select("key", value.alias("value")).select("key.*", "value.*")


def _unique_names(struct: T.StructType) -> T.StructType:
    seen: dict[str, int] = {}
    fields = []
    for field in struct.fields:
        seen[field.name] = seen.get(field.name, 0) + 1
        repeat = seen[field.name]
        name = field.name if repeat == 1 else f"{field.name}_{repeat}"
        fields.append(T.StructField(name, field.dataType, field.nullable))
    return T.StructType(fields)


def delivery_snapshot(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    batch_id: int | None = None,
) -> DataFrame:
    """The state of an ``aggregate_reconcile`` query, with the columns that query emits.

    The stored fields are the aggregates' buffers in the order of the query, several
    of them under one name, so they are named here by position.
    """
    stored = state_snapshot(spark, checkpoint, batch_id=batch_id)
    return with_status(stored.toDF(*keys, *_buffers(types)), keys, types)


def _buffers(types: Sequence[str]) -> list[str]:
    """Names of the fields that an ``aggregate_reconcile`` query keeps of a request, in order."""
    declared = [M.declared_column(t) for t in types]
    newest = [name for d in declared for name in (d, f"_when_{d}")]
    return [*newest, *[M.received_column(t) for t in types], "n_control", "n_data", "last_ts"]


def delivery_history(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    first_batch: int = 0,
    last_batch: int | None = None,
) -> DataFrame:
    """How every request stood after each micro-batch that touched it, from the state's change feed.

    One row per request and ``batch_id``, with the columns that an ``aggregate_reconcile``
    query emits: a series of snapshots of which each holds only what changed. The
    checkpoint must still have the changes of ``first_batch`` and those after it; by
    default Spark keeps those of the last 100 micro-batches.
    """
    spark.streams  # see state_snapshot
    reader = (
        spark.read.format("statestore")
        .option("operatorId", 0)
        .option("readChangeFeed", "true")
        .option("changeStartBatchId", first_batch)
    )
    if last_batch is not None:
        reader = reader.option("changeEndBatchId", last_batch)
    changes = reader.load(checkpoint).where(F.col("change_type") == "update")
    value = F.col("value").cast(_unique_names(changes.schema["value"].dataType))
    named = changes.select("batch_id", "key", value.alias("value")).select("batch_id", "key.*", "value.*")
    return with_status(named.toDF("batch_id", *keys, *_buffers(types)), keys, types, also=["batch_id"])
