"""Message envelopes: bytes to columns, columns to bytes, and what could not be decoded.

A decoder is a function from a binary column to a struct column. It marks bytes
it cannot read by a null struct or by a non-null ``corrupt`` field. An encoder is
a function from a struct column to a binary column, null for a row that is not a
message. The JSON pair here is the default; ``protobuf`` has the binary one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import messages as M, statistics as S

Codec = Callable[[Column], Column]

CONTROL = "control"
DATA = "data"
TOPICS = {CONTROL: M.CONTROL_TOPIC, DATA: M.DATA_TOPIC}

NULL_KEY = "NULL_KEY"
BAD_KEY = "BAD_KEY"
NULL_VALUE = "NULL_VALUE"
BAD_VALUE = "BAD_VALUE"
NULL_STATISTICS = "NULL_STATISTICS"
NULL_COUNT = "NULL_COUNT"
COUNT_TOO_LARGE = "COUNT_TOO_LARGE"
UNKNOWN_TYPE = "UNKNOWN_TYPE"
MISSING_TYPE = "MISSING_TYPE"

# Largest count the int32 of the binary wire format holds; JSON has no such limit.
MAX_WIRE_COUNT = 2**31 - 1

# Fixed field names of the message format, in field order.
KEY_FIELDS = "ReqId string, FOId string"
CONTROL_FIELDS = "FOName string, Statistics map<string,bigint>"
DATA_FIELDS = "Type string, Id string, Value string"

_CORRUPT = "corrupt"
_JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}


@dataclass(frozen=True)
class MessageCodec:
    """The three decoders or the three encoders of one wire format, and what the format can hold."""

    key: Codec
    control: Codec
    data: Codec
    max_count: int | None = None
    types: tuple[str, ...] | None = None


def json_decoder(fields: str) -> Codec:
    """Decoder for JSON text with the given fields; absent fields come out null."""
    schema = f"{fields}, {_CORRUPT} string"
    return lambda payload: F.from_json(payload.cast("string"), schema, _JSON_OPTIONS)


def json_encoder(payload: Column) -> Column:
    return F.to_json(payload).cast("binary")


JSON_DECODERS = MessageCodec(json_decoder(KEY_FIELDS), json_decoder(CONTROL_FIELDS), json_decoder(DATA_FIELDS))
JSON_ENCODERS = MessageCodec(json_encoder, json_encoder, json_encoder)


def _type_from_wire(column: Column, types: Sequence[str]) -> Column:
    """A wire enum is a name or a number in text; unset means the first name."""
    name = M.normalise_type(column, types)
    for number, type_name in enumerate(types):
        name = F.when(column == str(number), F.lit(type_name)).otherwise(name)
    return name


def _failure(df: DataFrame, part: str, raw: str, when_null: str, when_bad: str) -> Column:
    bad = F.col(part).isNull()
    if _CORRUPT in df.schema[part].dataType.names:
        bad = bad | F.col(f"{part}.{_CORRUPT}").isNotNull()
    return F.when(F.col(raw).isNull(), F.lit(when_null)).when(bad, F.lit(when_bad))


def decode_messages(
    raw: DataFrame,
    kind: str,
    decoders: MessageCodec = JSON_DECODERS,
    types: Sequence[str] = M.TYPES,
) -> DataFrame:
    """Decode envelopes of one kind to message columns, keeping every row.

    Unset fields read as "", 0 or an empty map, never null. A row whose key or value
    cannot be decoded has null message columns and the reason in ``error``; the raw
    bytes stay in ``raw_key`` and ``raw_value`` for ``quarantine``. Columns besides
    the envelope's own (a partition, an offset) pass through.
    """
    carried = [name for name in raw.columns if name not in ("key", "value", "topic", "timestamp")]
    time = F.col("timestamp") if "timestamp" in raw.columns else F.lit(None).cast("timestamp")
    value_decoder = decoders.control if kind == CONTROL else decoders.data
    parsed = raw.select(
        F.col("key").alias("raw_key"),
        F.col("value").alias("raw_value"),
        time.alias("ts"),
        *carried,
        decoders.key(F.col("key")).alias("_key"),
        value_decoder(F.col("value")).alias("_value"),
    )
    error = F.coalesce(
        _failure(parsed, "_key", "raw_key", NULL_KEY, BAD_KEY),
        _failure(parsed, "_value", "raw_value", NULL_VALUE, BAD_VALUE),
    )
    # A filter on the error would move below the parsing and parse everything twice.
    # Filters do not move across a generator, so a one-element one keeps it at once.
    once = F.explode(F.array(F.struct("_key", "_value", error.alias("error")))).alias("_message")
    flagged = parsed.select("raw_key", "raw_value", "ts", *carried, once).select(
        "raw_key", "raw_value", "ts", *carried, "_message.*"
    )
    fields = {
        "req_id": M.text_or_empty(F.col("_key.ReqId")),
        "fo_id": M.text_or_empty(F.col("_key.FOId")),
    }
    if kind == CONTROL:
        counts = S.last_entry_wins(S.statistics_or_empty(F.col("_value.Statistics")))
        fields["fo_name"] = M.text_or_empty(F.col("_value.FOName"))
        fields["statistics"] = F.transform_values(counts, lambda _, n: F.coalesce(n, F.lit(0).cast("bigint")))
    elif kind == DATA:
        fields["type"] = _type_from_wire(F.col("_value.Type"), types)
        fields["id"] = M.text_or_empty(F.col("_value.Id"))
        fields["value"] = M.text_or_empty(F.col("_value.Value"))
    else:
        raise ValueError(f"kind must be {CONTROL} or {DATA}, not {kind!r}")
    decoded = {name: F.when(F.col("error").isNull(), column).alias(name) for name, column in fields.items()}
    return flagged.select(*decoded.values(), "ts", *carried, "error", "raw_key", "raw_value")


def quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split decoded rows into good messages and rejected envelopes with their reason."""
    message_columns = [name for name in decoded.columns if name not in ("error", "raw_key", "raw_value")]
    envelope_columns = [
        name
        for name in decoded.columns
        if name not in (*M.KEYS, "fo_name", "statistics", "type", "id", "value")
    ]
    good = decoded.where(F.col("error").isNull()).select(*message_columns)
    bad = decoded.where(F.col("error").isNotNull()).select(*envelope_columns)
    return good, bad


def incomplete_announcements(decoded: DataFrame, types: Sequence[str] = M.TYPES) -> DataFrame:
    """Decoded control messages that lack a type, as rejected envelopes with the reason.

    They are messages all the same: a request whose newest one lacks a type is in a state of
    its own, so they stay among the good ones as well.
    """
    absent = F.filter(F.array(*[F.lit(t) for t in types]), lambda t: ~F.map_contains_key("statistics", t))
    reason = F.concat(F.lit(f"{MISSING_TYPE}:"), F.array_join(absent, ","))
    good = decoded.where(F.col("error").isNull())
    lacking = good.where(F.size(absent) > 0).withColumn("error", reason)
    return quarantine(lacking)[1]


def encoding_error(kind: str, encoders: MessageCodec = JSON_ENCODERS, types: Sequence[str] = M.TYPES) -> Column:
    """Why a row is no message of the wire format, null if it is one."""
    if kind == CONTROL:
        counts = F.map_values("statistics")
        error = F.when(F.col("statistics").isNull(), F.lit(NULL_STATISTICS))
        error = error.when(F.exists(counts, lambda n: n.isNull()), F.lit(NULL_COUNT))
        if encoders.max_count is not None:
            large = F.exists(counts, lambda n: ~n.between(-encoders.max_count - 1, encoders.max_count))
            error = error.when(large, F.lit(COUNT_TOO_LARGE))
        return error
    known = [t for t in types if encoders.types is None or t in encoders.types]
    return F.when(~F.coalesce(F.col("type").isin(*known), F.lit(False)), F.lit(UNKNOWN_TYPE))


def screen_messages(
    df: DataFrame, kind: str, encoders: MessageCodec = JSON_ENCODERS, types: Sequence[str] = M.TYPES
) -> tuple[DataFrame, DataFrame]:
    """Split message rows into those that can be encoded, and the others with the reason in ``error``."""
    error = encoding_error(kind, encoders, types)
    return df.where(error.isNull()), df.withColumn("error", error).where(F.col("error").isNotNull())


def encode_messages(
    df: DataFrame,
    kind: str,
    encoders: MessageCodec = JSON_ENCODERS,
    topic: str | None = None,
    extra: Sequence[str] = (),
    types: Sequence[str] = M.TYPES,
    invalid: str = "null",
) -> DataFrame:
    """Envelope columns for message rows.

    A row that is no valid message gets a null value, or fails the query with
    ``invalid="fail"``; ``screen_messages`` sorts such rows out beforehand.
    """
    if invalid not in ("null", "fail"):
        raise ValueError(f"invalid must be null or fail, not {invalid!r}")
    key = F.struct(F.col("req_id").alias("ReqId"), F.col("fo_id").alias("FOId"))
    if kind == CONTROL:
        body = F.struct(F.col("fo_name").alias("FOName"), F.col("statistics").alias("Statistics"))
        value = encoders.control(body)
    elif kind == DATA:
        body = F.struct(F.col("type").alias("Type"), F.col("id").alias("Id"), F.col("value").alias("Value"))
        value = encoders.data(body)
    else:
        raise ValueError(f"kind must be {CONTROL} or {DATA}, not {kind!r}")
    time = F.col("ts").cast("timestamp") if "ts" in df.columns else F.lit(None).cast("timestamp")
    error = encoding_error(kind, encoders, types)
    checked = F.when(error.isNull(), value)
    if invalid == "fail":
        checked = checked.otherwise(F.raise_error(F.concat(F.lit("not a message: "), error)).cast("binary"))
    return df.select(
        encoders.key(key).alias("key"),
        checked.alias("value"),
        F.lit(topic or TOPICS[kind]).alias("topic"),
        time.alias("timestamp"),
        *extra,
    )
