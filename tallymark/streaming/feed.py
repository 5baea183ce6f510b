"""One stream of counter updates out of a control stream and a data stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import counters as C, messages as M
from ..operators.counting import declared_counts


def delivery_feed(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    ts: str = "ts",
    seq: str | None = None,
    missing: str = "zero",
) -> DataFrame:
    """Union of both inputs in one shape: who, when, what was declared, what was received.

    A control row declares and receives nothing, a data row declares nothing (null)
    and receives one record of its type. ``seq`` names a column (an offset, a sequence
    number) that orders control messages of equal time. Only the columns a counter
    needs are kept, so ids, values and names never reach the shuffle.
    """

    def shared(df: DataFrame) -> list:
        order = F.col(seq).cast("bigint") if seq else F.lit(0).cast("bigint")
        return [*keys, F.col(ts).cast("timestamp").alias("ts"), order.alias("seq")]

    announced = declared_counts(control, types, missing)
    controls = announced.select(
        *shared(announced),
        F.lit(True).alias("is_control"),
        *[F.col(M.declared_column(t)).cast("bigint").alias(M.declared_column(t)) for t in types],
        *[F.lit(0).cast("bigint").alias(M.received_column(t)) for t in types],
    )
    records = data.select(
        *shared(data),
        F.lit(False).alias("is_control"),
        *[F.lit(None).cast("bigint").alias(M.declared_column(t)) for t in types],
        *[C.type_flag(F.col("type"), t).alias(M.received_column(t)) for t in types],
    )
    return controls.unionByName(records)
