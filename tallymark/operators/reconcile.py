"""Batch reconciliation of declared against received counts."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import counters as C, messages as M
from .counting import declared_counts, type_counts


_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Microseconds beyond any time Spark can hold.
_NO_TIME = 900_000_000_000_000_000
_DAY_US = 86_400_000_000


def _micros(column: str, kind: T.DataType) -> Column:
    """Microseconds since 1970 of a date or time; of a wall-clock time, whatever the session's zone is."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    days = F.unix_date(F.to_date(column)).cast("bigint") * _DAY_US
    if isinstance(kind, T.DateType):
        return days
    seconds = F.hour(column) * 3600 + F.minute(column) * 60
    return days + seconds.cast("bigint") * 1_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")


def ordering(df: DataFrame, columns: Sequence[str], unknown_first: bool = True) -> Column:
    """Sort key of one or more columns as a single comparable column that is never null.

    A row without a time or number sorts before all others, or after them, so that
    it is taken only where there is no better one. A lone time or number, and a time with a
    number behind it, keep a fixed width, with which Spark can use a hash aggregation.
    """
    kinds = [df.schema[c].dataType for c in columns]
    if len(columns) == 2 and isinstance(kinds[0], _TIMES) and isinstance(kinds[1], _WHOLE_NUMBERS):
        # One decimal: microseconds in front, the number in the last 65 bits.
        micros = F.coalesce(_micros(columns[0], kinds[0]), F.lit(-_NO_TIME if unknown_first else _NO_TIME))
        number = F.coalesce(F.col(columns[1]).cast("decimal(20,0)"), F.lit(Decimal(-(2**63) - 1 if unknown_first else 2**63)))
        return micros.cast("decimal(18,0)") * F.lit(Decimal(2**65)) + number.cast("decimal(20,0)")
    if len(columns) == 1:
        kind = df.schema[columns[0]].dataType
        if isinstance(kind, _TIMES):
            return F.coalesce(columns[0], F.lit("0001-01-01" if unknown_first else "9999-12-31").cast(kind))
        if isinstance(kind, _WHOLE_NUMBERS):
            return F.coalesce(F.col(columns[0]).cast("bigint"), F.lit(-(2**63) if unknown_first else 2**63 - 1))
    known = [F.col(c).isNotNull() if unknown_first else F.col(c).isNull() for c in columns]
    return F.struct(*[part for flag, c in zip(known, columns) for part in (flag, F.col(c))])


def latest_control(
    control: DataFrame,
    keys: Sequence[str] = M.KEYS,
    order_by: Sequence[str] = ("ts",),
) -> DataFrame:
    """The newest control message of each request; a newer one replaces an older one whole.

    An aggregate rather than a ranking window: it combines map-side, so a request
    with very many control messages never gathers them in one task.
    """
    rest = [name for name in control.columns if name not in keys]
    newest = F.max_by(F.struct(*rest), ordering(control, order_by)).alias("_newest")
    return control.groupBy(*keys).agg(newest).select(*keys, *[f"_newest.{name}" for name in rest])


def latest_declared(
    control: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    order_by: Sequence[str] = ("ts",),
    missing: str = "zero",
) -> DataFrame:
    """Declared counts of the newest control message, without carrying its other fields.

    With ``missing="quarantine"`` a type that the newest message lacks is null: an older
    message that had it does not come back.
    """
    declared = declared_counts(control, types, missing)
    by = ordering(control, order_by)
    names = [M.declared_column(t) for t in types]
    return declared.groupBy(*keys).agg(*[F.max_by(name, by).alias(name) for name in names])


def dedup_data(data: DataFrame, keys: Sequence[str] = M.KEYS, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one record per request, type and id.

    The type is part of the identity because ids restart for each type. With
    ``order_by`` the first record in that order is kept, otherwise any one; either
    way copies collapse map-side before the shuffle.
    """
    identity = [*keys, "type", "id"]
    if order_by is None:
        return data.dropDuplicates(identity)
    rest = [name for name in data.columns if name not in identity]
    first = F.min_by(F.struct(*rest), ordering(data, order_by, unknown_first=False)).alias("_first")
    return data.groupBy(*identity).agg(first).select(*identity, *[f"_first.{name}" for name in rest])


def reconcile_counts(
    declared: DataFrame,
    received: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
) -> DataFrame:
    """Full outer join of one declared row and one received row per request, with deltas and status."""
    control = declared.select(*keys, *[M.declared_column(t) for t in types], F.lit(True).alias("_control"))
    data = received.select(*keys, *[M.received_column(t) for t in types], F.lit(True).alias("_data"))
    joined = control.join(data, list(keys), "full_outer")
    has_control = F.col("_control").isNotNull()
    has_data = F.col("_data").isNotNull()
    return joined.select(
        *keys,
        *[C.or_zero(F.col(M.declared_column(t))).alias(M.declared_column(t)) for t in types],
        *[C.or_zero(F.col(M.received_column(t))).alias(M.received_column(t)) for t in types],
        *[column.alias(M.delta_column(t)) for t, column in C.deltas(types).items()],
        has_control.alias("has_control"),
        has_data.alias("has_data"),
        C.delivery_status(has_control, has_data, types).alias("status"),
    )


def reconcile(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    order_by: Sequence[str] = ("ts",),
    missing: str = "zero",
) -> DataFrame:
    """Delivery status of every request seen on either side.

    Both sides are reduced to one row per request before they meet, so raw records
    never go through the join and a huge request is an ordinary row of it.
    """
    return reconcile_counts(
        latest_declared(control, keys, types, order_by, missing),
        type_counts(data, keys, types),
        keys,
        types,
    )


def status_summary(reconciled: DataFrame) -> DataFrame:
    """Requests per status, and how many of them had no data at all."""
    return reconciled.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(~F.col("has_data"), F.lit(1))).alias("no_data_rows"),
    )


def completion_delta(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    order_by: Sequence[str] = ("ts",),
) -> DataFrame:
    """Declared minus received for requests present on both sides (inner join)."""
    declared = latest_declared(control, keys, types, order_by)
    return declared.join(type_counts(data, keys, types), list(keys), "inner").select(
        *keys, *[column.alias(M.delta_column(t)) for t, column in C.deltas(types).items()]
    )


def completed(df: DataFrame, types: Sequence[str] = M.TYPES) -> DataFrame:
    """Rows whose delivery is complete: by status where there is one, else by zero deltas."""
    if "status" in df.columns:
        return df.where(F.col("status") == C.COMPLETE)
    return df.where(C.is_complete(types))


def notifications(df: DataFrame, keys: Sequence[str] = M.KEYS) -> DataFrame:
    """The text notice of each completed request; its first key column names the request."""
    notice = F.concat(F.col(keys[0]), F.lit(M.FINISHED_SUFFIX))
    return df.where(F.col(keys[0]).isNotNull()).select(*keys, notice.alias("message"))


def data_without_control(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
) -> DataFrame:
    """Requests that received data but were never announced, with their received counts."""
    announced = control.select(*keys).distinct()
    return type_counts(data, keys, types).join(announced, list(keys), "left_anti")


def control_without_data(
    control: DataFrame,
    data: DataFrame,
    keys: Sequence[str] = M.KEYS,
    types: Sequence[str] = M.TYPES,
    order_by: Sequence[str] = ("ts",),
) -> DataFrame:
    """Requests that were announced but received no data at all, with their declared counts."""
    declared = latest_declared(control, keys, types, order_by)
    return declared.join(data.select(*keys).distinct(), list(keys), "left_anti")
