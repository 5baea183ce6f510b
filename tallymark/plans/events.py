"""The event table as a delivery with a clock: each user and day is one request.

The frames are keyed by ``user_id`` and ``day``; text keys are rendered on results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import messages as M, statistics as S
from ..operators import counting, history as H
from ..operators.reconcile import reconcile
from ..session import new_table_path
from ..sources import codec, protobuf
from .delivery import publish_delivery, read_delivered
from .tables import table

KEYS = ("user_id", "day")
TRADE, MARKET = M.TYPES


def event_type(column: Column) -> Column:
    return (
        F.when(column == "purchase", F.lit(TRADE))
        .when(column == "view", F.lit(MARKET))
        .otherwise(F.lit(M.UNRECOGNIZED))
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Every event as a data message of its user and day; ``seq`` is the event's number."""
    keyed = events.withColumns({"day": F.col("ts").cast("date"), "seq": F.col("event_id")})
    return counting.to_data_messages(
        keyed,
        keys=KEYS,
        number=F.col("event_id"),
        value=F.get_json_object("props", "$.k"),
        type=event_type(F.col("event_type")),
        ts=F.col("ts"),
        extra=("seq",),
        types=None,
    )


def data(spark: SparkSession, folder: str) -> DataFrame:
    return event_messages(table(spark, folder, "events"))


def control(spark: SparkSession, folder: str) -> DataFrame:
    """Announced together with a request's first record; users ending in 0 announce one
    trade too many and so never complete."""
    received = data(spark, folder).groupBy(*KEYS).agg(
        F.min("ts").alias("ts"),
        *[F.count(F.when(F.col("type") == t, F.lit(1))).alias(M.received_column(t)) for t in M.TYPES],
    )
    surplus = F.when(F.col("user_id") % 10 == 0, F.lit(1)).otherwise(F.lit(0))
    return received.select(
        *KEYS,
        F.concat(F.lit(M.OFFICE_NAME_PREFIX), (F.col("user_id") % 10).cast("string")).alias("fo_name"),
        S.build_statistics(
            {TRADE: F.col(M.received_column(TRADE)) + surplus, MARKET: F.col(M.received_column(MARKET))}
        ).alias("statistics"),
        "ts",
        F.lit(0).cast("bigint").alias("seq"),
    )


def render_key(df: DataFrame) -> DataFrame:
    """Replace the compact key by the two text columns of a message key."""
    rest = [name for name in df.columns if name not in KEYS]
    return counting.with_message_key(df, "user_id", "day").select(*M.KEYS, *rest)


def running_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = H.running_counts(data(spark, folder).select(*KEYS, "type", "ts", "seq"), KEYS)
    return render_key(counted).drop("type")


def first_completion(spark: SparkSession, folder: str) -> DataFrame:
    return render_key(H.first_completion(control(spark, folder), data(spark, folder), KEYS))


# A request above so many records is hot in the queries that show how such requests are cut.
HOT_EVENTS = 1000


def _into_one_request(df: DataFrame) -> DataFrame:
    """Every third user's records as those of a single request, whose second key part is unknown."""
    third = F.col("user_id") % 3 == 0
    return df.withColumns(
        {
            "day": F.when(~third, F.col("day")),
            "user_id": F.when(third, F.lit(0).cast("bigint")).otherwise(F.col("user_id")),
        }
    )


def running_counts_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Running counts where one request owns a third of all records."""
    records = _into_one_request(data(spark, folder).select(*KEYS, "type", "ts", "seq"))
    return H.running_counts(records, KEYS, hot_rows=HOT_EVENTS).drop("type")


def first_completion_hot(spark: SparkSession, folder: str) -> DataFrame:
    """First completion where one request owns a third of all records and is announced anew again and again:
    every hundredth record announces the half of its own number as trades and three quarters of it as market data,
    but the last of them the true totals."""
    records = _into_one_request(data(spark, folder).select(*KEYS, "type", "ts", "seq"))
    totals = records.groupBy(*KEYS).agg(
        F.max("ts").alias("ts"),
        F.max("seq").alias("seq"),
        *[F.count(F.when(F.col("type") == t, F.lit(1))).alias(t) for t in M.TYPES],
    )
    revisions = records.where(F.col("seq") % 100 == 0).select(
        *KEYS,
        S.build_statistics(
            {TRADE: (F.col("seq") / 2).cast("bigint"), MARKET: (F.col("seq") * 3 / 4).cast("bigint")}
        ).alias("statistics"),
        "ts",
        "seq",
    )
    true = totals.select(*KEYS, S.build_statistics({t: F.col(t) for t in M.TYPES}).alias("statistics"), "ts", (F.col("seq") + 1).alias("seq"))
    return H.first_completion(revisions.unionByName(true), records, KEYS, hot_rows=HOT_EVENTS)


# One request per user for the operators that follow a request over days.
USER = ("user_id",)


def user_control(spark: SparkSession, folder: str) -> DataFrame:
    """Per user, the counts as of the middle of the month: the user is complete from the
    last record before it until the next one after it."""
    cutoff = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return (
        data(spark, folder)
        .groupBy(*USER)
        .agg(*[F.count(F.when(cutoff & (F.col("type") == t), F.lit(1))).alias(t) for t in M.TYPES], F.min("ts").alias("ts"))
        .select("user_id", S.build_statistics({t: F.col(t) for t in M.TYPES}).alias("statistics"), "ts")
    )


def daily_history(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's deltas at the end of every day with records."""
    return H.state_changes(user_control(spark, folder), data(spark, folder), USER)


def newly_completed(spark: SparkSession, folder: str) -> DataFrame:
    """Days on which a user turned complete or stopped being so."""
    # One row per user and day at most, so no timeline can be too long for a task.
    edges = H.newly_completed(daily_history(spark, folder), USER, edge="both", hot_rows=None)
    return counting.with_message_key(edges, "user_id").select(*M.KEYS, "snapshot_ts", "edge")


def snapshot_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The same over full daily snapshots in which only active users appear."""
    edges = H.newly_completed(daily_history(spark, folder), USER, edge="both", every="1 day")
    return counting.with_message_key(edges, "user_id").select(*M.KEYS, "snapshot_ts", "edge")


def windowed_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = H.windowed_counts(data(spark, folder), USER, length="2 days", slide="1 day")
    return counting.with_message_key(counted, "user_id").drop("user_id")


def _envelopes(spark: SparkSession, folder: str, encoders: codec.MessageCodec) -> DataFrame:
    """Encoded events, some of them damaged by the last two digits of the event number:
    0 cut short, 1 without value, 2 with an unreadable key, 3 without key."""
    messages = render_key(data(spark, folder)).withColumnRenamed("seq", "offset")
    encoded = codec.encode_messages(
        messages.withColumn("type", F.when(F.col("type").isin(*M.TYPES), F.col("type")).otherwise(F.lit(MARKET))),
        codec.DATA,
        encoders,
        extra=("offset",),
    )
    damage = F.col("offset") % 100
    cut = F.substring("value", 1, 5)
    nothing = F.lit(None).cast("binary")
    return encoded.withColumns(
        {
            "value": F.when(damage == 0, cut).when(damage == 1, nothing).otherwise(F.col("value")),
            "key": F.when(damage == 2, F.encode(F.lit("{"), "UTF-8")).when(damage == 3, nothing).otherwise(F.col("key")),
        }
    )


def decode_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """JSON envelopes decoded in one pass; a reject has its reason and no message."""
    decoded = codec.decode_messages(_envelopes(spark, folder, codec.JSON_ENCODERS), codec.DATA)
    return decoded.drop("ts", "raw_key", "raw_value")


def quarantined(spark: SparkSession, folder: str) -> DataFrame:
    """The rejected envelopes alone, with the bytes that arrived as text."""
    decoded = codec.decode_messages(_envelopes(spark, folder, codec.JSON_ENCODERS), codec.DATA)
    _, bad = codec.quarantine(decoded)
    return bad.select("offset", "error", *[F.col(name).cast("string").alias(name) for name in ("raw_key", "raw_value")])


def published_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Events published as topics: per user and day, the records that are of no known type and stay behind."""
    path = new_table_path(spark, "delivery")
    messages = render_key(data(spark, folder))
    publish_delivery(messages, F.lit("fo-0"), "parquet", f"{path}/topics", rejects=f"{path}/rejects")
    return (
        spark.read.parquet(f"{path}/rejects/{M.DATA_TOPIC}")
        .groupBy(*M.KEYS, "error")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _text_encoder(*fields: str):
    """Fields in order, with bars between them."""
    return lambda payload: F.concat_ws("|", *[payload[name] for name in fields]).cast("binary")


def _text_decoder(*fields: str):
    """The fields of such a text; null if it has more or fewer of them."""

    def decode(payload: Column) -> Column:
        parts = F.split(payload.cast("string"), r"\|")
        read = F.struct(*[F.get(parts, i).alias(name) for i, name in enumerate(fields)])
        return F.when(F.size(parts) == len(fields), read)

    return decode


_TEXT_KEY, _TEXT_DATA = ("ReqId", "FOId"), ("Type", "Id", "Value")
TEXT_ENCODERS = codec.MessageCodec(_text_encoder(*_TEXT_KEY), codec.json_encoder, _text_encoder(*_TEXT_DATA))
TEXT_DECODERS = codec.MessageCodec(
    _text_decoder(*_TEXT_KEY), codec.json_decoder(codec.CONTROL_FIELDS), _text_decoder(*_TEXT_DATA)
)


def decode_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same envelopes in a text form of our own, whose codec is a few column functions."""
    decoded = codec.decode_messages(_envelopes(spark, folder, TEXT_ENCODERS), codec.DATA, TEXT_DECODERS)
    return decoded.drop("ts", "raw_key", "raw_value")


def published_repeatedly(spark: SparkSession, folder: str) -> DataFrame:
    """Status of what two deliveries brought of which one was published twice and one broke off first."""
    path = new_table_path(spark, "delivery")
    records = render_key(data(spark, folder).where(F.col("type").isin(*M.TYPES)))
    odd = F.crc32(F.col("req_id").cast("binary")) % 2 == 1

    def publish(part: Column, delivery_id: str) -> None:
        publish_delivery(records.where(part), F.lit("fo-0"), "parquet", path, delivery_id=delivery_id)

    publish(odd, "odd")
    publish(odd, "odd")
    # A run that got no further than its announcements.
    torn = counting.control_totals(records.where(~odd), ts="ts").withColumn("fo_name", F.lit("fo-0"))
    envelopes = codec.encode_messages(torn, codec.CONTROL)
    envelopes.write.parquet(f"{path}/{M.CONTROL_TOPIC}/delivery=even/attempt=0")
    publish(~odd, "even")
    good = [codec.quarantine(read_delivered(spark, path, kind))[0] for kind in (codec.CONTROL, codec.DATA)]
    return reconcile(*good)


def decode_protobuf(spark: SparkSession, folder: str) -> DataFrame:
    """The same envelopes in the binary wire format."""
    raw = _envelopes(spark, folder, protobuf.arrow_encoders())
    decoded = codec.decode_messages(raw, codec.DATA, protobuf.arrow_decoders())
    return decoded.drop("ts", "raw_key", "raw_value")
