"""Message vocabulary: fixed names, frame schemas, and column helpers for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# Fixed values of the message format: enum names in number order, the name of a
# number outside the enum, topic names, and the text forms of ids and notices.
TYPES = ("TRADE_DATA", "MARKET_DATA")
UNRECOGNIZED = "UNRECOGNIZED"
CONTROL_TOPIC = "ctrl"
DATA_TOPIC = "data"
REQUEST_PREFIX = "REQ-"
OFFICE_PREFIX = "FO-"
OFFICE_NAME_PREFIX = "fo-"
RECORD_PREFIX = "Trade-"
FINISHED_SUFFIX = " Finished."
COUNTS_TEMPLATE = "num trade: %d; num market data: %d"

KEYS = ("req_id", "fo_id")

# Counts are bigint: one request may hold more records than an int32 can count.
CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("req_id", T.StringType()),
        T.StructField("fo_id", T.StringType()),
        T.StructField("fo_name", T.StringType()),
        T.StructField("statistics", T.MapType(T.StringType(), T.LongType())),
        T.StructField("ts", T.TimestampType()),
    ]
)
DATA_SCHEMA = T.StructType(
    [
        T.StructField("req_id", T.StringType()),
        T.StructField("fo_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def slug(type_name: str) -> str:
    """Column-name form of a record type: ``TRADE_DATA`` -> ``trade_data``."""
    return type_name.lower()


def declared_column(type_name: str) -> str:
    return f"declared_{slug(type_name)}"


def received_column(type_name: str) -> str:
    return f"received_{slug(type_name)}"


def delta_column(type_name: str) -> str:
    return f"delta_{slug(type_name)}"


def text_or_empty(column: Column) -> Column:
    """An unset text field reads as the empty string, never null."""
    return F.coalesce(column, F.lit(""))


def normalise_type(column: Column, types: Sequence[str] = TYPES) -> Column:
    """Known type names stay, an unset one is the first type, anything else is UNRECOGNIZED."""
    return (
        F.when(column.isNull(), F.lit(types[0]))
        .when(column.isin(*types), column)
        .otherwise(F.lit(UNRECOGNIZED))
    )


def type_from_number(column: Column, types: Sequence[str] = TYPES) -> Column:
    """Enum number to enum name; a number outside the enum is UNRECOGNIZED."""
    name = F.when(column.isNull(), F.lit(types[0]))
    for number, type_name in enumerate(types):
        name = name.when(column == number, F.lit(type_name))
    return name.otherwise(F.lit(UNRECOGNIZED))


def request_id(column: Column) -> Column:
    return F.concat(F.lit(REQUEST_PREFIX), column.cast("string"))


def office_id(column: Column) -> Column:
    return F.concat(F.lit(OFFICE_PREFIX), column.cast("string"))


def record_id(column: Column) -> Column:
    return F.concat(F.lit(RECORD_PREFIX), column.cast("string"))
