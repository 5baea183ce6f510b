"""Counter arithmetic: one count per record type, kept as plain bigint columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from .messages import (
    COUNTS_TEMPLATE,
    TYPES,
    declared_column,
    delta_column,
    received_column,
)

NO_CTRL = "NO_CTRL"
BAD_CTRL = "BAD_CTRL"
COMPLETE = "COMPLETE"
NO_DATA = "NO_DATA"
OVER = "OVER"
INCOMPLETE = "INCOMPLETE"
EXPIRED = "EXPIRED"


def type_flag(type_column: Column, type_name: str) -> Column:
    """1 for a record of the type, 0 for any other record."""
    return F.when(type_column == type_name, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def count_of_type(type_column: Column, type_name: str) -> Column:
    """Aggregate: how many records of the type. Never null."""
    return F.count(F.when(type_column == type_name, F.lit(1)))


def or_zero(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("bigint"))


def deltas(types: Sequence[str] = TYPES) -> dict[str, Column]:
    """Declared minus received per type; an absent side counts as zero."""
    return {
        t: or_zero(F.col(declared_column(t))) - or_zero(F.col(received_column(t))) for t in types
    }


def all_zero(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [column == 0 for column in columns])


def any_negative(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [column < 0 for column in columns])


def is_complete(types: Sequence[str] = TYPES) -> Column:
    """True when every delta column is zero; a negative delta is not complete."""
    return all_zero([F.col(delta_column(t)) for t in types])


def delivery_status(has_control: Column, has_data: Column, types: Sequence[str] = TYPES) -> Column:
    """Status of a request from declared and received columns; the first rule that holds decides.

    A null count beside a control message stands for a type that it should have named and did not.
    """
    difference = list(deltas(types).values())
    unnamed = reduce(lambda a, b: a | b, [F.col(declared_column(t)).isNull() for t in types])
    return (
        F.when(~has_control, F.lit(NO_CTRL))
        .when(unnamed, F.lit(BAD_CTRL))
        .when(all_zero(difference), F.lit(COMPLETE))
        .when(~has_data, F.lit(NO_DATA))
        .when(any_negative(difference), F.lit(OVER))
        .otherwise(F.lit(INCOMPLETE))
    )


def describe(trades: Column, market: Column) -> Column:
    """Text form of a pair of counts."""
    return F.format_string(COUNTS_TEMPLATE, trades, market)
