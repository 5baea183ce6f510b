"""Orders and line items as a delivery: an order announces how many items it has.

The frames are keyed by the compact ``order_key``; text keys are rendered on results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import counters as C, messages as M, statistics as S
from ..operators import counting, reconcile as R
from ..session import new_table_path
from ..sources import codec
from ..sources.readers import read_control, read_data
from .delivery import publish_delivery
from .tables import table

KEYS = ("order_key",)
TRADE, MARKET = M.TYPES


def line_type(status: Column) -> Column:
    return F.when(status == "O", F.lit(TRADE)).when(status == "F", F.lit(MARKET)).otherwise(F.lit(M.UNRECOGNIZED))


def item_messages(lineitem: DataFrame) -> DataFrame:
    """Every line item as a data message of its order; a null key would be no message."""
    keyed = lineitem.where(F.col("l_orderkey").isNotNull()).withColumn("order_key", F.col("l_orderkey"))
    return counting.to_data_messages(
        keyed,
        keys=KEYS,
        number=F.col("l_linenumber"),
        value=F.col("l_quantity").cast("bigint"),
        type=line_type(F.col("l_linestatus")),
        ts=F.col("l_shipdate"),
        types=None,
    )


def data(spark: SparkSession, folder: str) -> DataFrame:
    return item_messages(table(spark, folder, "lineitem"))


def control(spark: SparkSession, folder: str) -> DataFrame:
    """Announcements with known faults: by the last digit of the order key, 0 announces
    one trade too many, 1 one too few, 2 announces nothing at all."""
    counts = counting.type_counts(data(spark, folder), KEYS)
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("ts")
    )
    digit = F.col("order_key") % 10
    trades = C.or_zero(F.col(M.received_column(TRADE)))
    announced = (
        F.when(digit == 0, trades + 1)
        .when(digit == 1, F.greatest(trades - 1, F.lit(0)))
        .when(digit != 2, trades)
    )
    # Orders without announcement are dropped by the computed count, after the join: a
    # condition on the key alone would also filter this side's line items, and Spark could
    # no longer share one scan and one shuffle of them with the received counts.
    return (
        orders.join(counts, list(KEYS), "left")
        .withColumn("announced", announced)
        .where(F.col("announced").isNotNull())
        .select(
            "order_key",
            F.concat(F.lit(M.OFFICE_NAME_PREFIX), digit.cast("string")).alias("fo_name"),
            S.build_statistics(
                {TRADE: F.col("announced"), MARKET: C.or_zero(F.col(M.received_column(MARKET)))}
            ).alias("statistics"),
            "ts",
        )
    )


def render_key(df: DataFrame) -> DataFrame:
    """Replace the compact key by the two text columns of a message key."""
    rest = [name for name in df.columns if name != "order_key"]
    return counting.with_message_key(df, "order_key").select(*M.KEYS, *rest)


def data_messages(spark: SparkSession, folder: str) -> DataFrame:
    return render_key(data(spark, folder)).drop("ts")


def type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return render_key(counting.type_counts(data(spark, folder), KEYS))


def control_totals(spark: SparkSession, folder: str) -> DataFrame:
    totals = counting.control_totals(data(spark, folder), KEYS)
    return render_key(counting.explode_statistics(totals, KEYS))


def describe_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = counting.type_counts(data(spark, folder), KEYS)
    described = counting.describe_counts(counts, M.received_column(TRADE), M.received_column(MARKET))
    return render_key(described.select(*KEYS, "description"))


def _sketchy_control(spark: SparkSession, folder: str) -> DataFrame:
    """Announcements straight from the order table; every seventh lacks the market entry."""
    key = F.col("o_orderkey")
    full = S.build_statistics({TRADE: key % 7, MARKET: key % 5})
    partial = S.remove_statistics(full, MARKET)
    return table(spark, folder, "orders").select(
        key.alias("order_key"),
        F.concat(F.lit(M.OFFICE_NAME_PREFIX), (key % 10).cast("string")).alias("fo_name"),
        F.when(key % 7 == 0, partial).otherwise(full).alias("statistics"),
        F.col("o_orderdate").alias("ts"),
    )


def declared_counts(spark: SparkSession, folder: str) -> DataFrame:
    profiled = counting.control_profile(_sketchy_control(spark, folder))
    declared = counting.declared_counts(profiled, missing="zero")
    return render_key(declared).drop("ts", "fo_name")


def declared_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The same announcements with a missing type treated as an error."""
    declared = counting.declared_counts(_sketchy_control(spark, folder), missing="quarantine")
    return render_key(declared).drop("ts", "fo_name")


def declared_or_fail(spark: SparkSession, folder: str) -> DataFrame:
    """Complete announcements, read in a way that fails the query if one lacks a type."""
    key = F.col("o_orderkey")
    control = table(spark, folder, "orders").select(
        key.alias("order_key"), S.build_statistics({TRADE: key % 7, MARKET: key % 5}).alias("statistics")
    )
    return render_key(counting.declared_counts(control, missing="fail"))


def _revised_control(spark: SparkSession, folder: str) -> DataFrame:
    """Announcements that are revised: every third order a day later, every fifth at the
    same moment, told apart by the sequence number only."""
    key = F.col("o_orderkey")
    trades = key % 7
    first = F.struct(F.lit(0).alias("seq"), F.lit(0).alias("days"), trades.alias("trades"))
    later = F.struct(F.lit(1).alias("seq"), F.lit(1).alias("days"), (trades + 1).alias("trades"))
    again = F.struct(F.lit(2).alias("seq"), F.lit(0).alias("days"), (trades + 2).alias("trades"))
    revisions = F.array_compact(
        F.array(F.when(key % 3 == 0, later), F.when(key % 5 == 0, again), first)
    )
    return (
        table(spark, folder, "orders")
        .select(key.alias("order_key"), "o_orderdate", F.explode(revisions).alias("r"))
        .select(
            "order_key",
            F.concat(F.lit(M.OFFICE_NAME_PREFIX), F.col("r.seq").cast("string")).alias("fo_name"),
            S.build_statistics({TRADE: F.col("r.trades"), MARKET: F.col("order_key") % 5}).alias("statistics"),
            (F.col("o_orderdate") + F.make_dt_interval(days=F.col("r.days"))).alias("ts"),
            F.col("r.seq").cast("bigint").alias("seq"),
        )
    )


def latest_control(spark: SparkSession, folder: str) -> DataFrame:
    newest = R.latest_control(_revised_control(spark, folder), KEYS, order_by=("ts", "seq"))
    return render_key(counting.declared_counts(newest))


def latest_control_edge(spark: SparkSession, folder: str) -> DataFrame:
    """Newest announcements where it is not plain which is newest: every fourth order has one
    without a time too, every eleventh has that one alone, and the newest of every third
    lacks the market entry, which the older one had."""
    key = F.col("o_orderkey")
    full = S.build_statistics({TRADE: key % 7 + 1, MARKET: key % 5})
    old = F.struct(F.lit(0).alias("days"), S.build_statistics({TRADE: key % 7, MARKET: key % 5 + 1}).alias("s"))
    new = F.struct(F.lit(1).alias("days"), F.when(key % 3 == 0, S.remove_statistics(full, MARKET)).otherwise(full).alias("s"))
    timeless = F.struct(F.lit(None).cast("int").alias("days"), S.build_statistics({TRADE: F.lit(99), MARKET: F.lit(99)}).alias("s"))
    sent = F.array_compact(
        F.array(
            F.when(key % 11 != 0, new), F.when(key % 11 != 0, old), F.when((key % 4 == 0) | (key % 11 == 0), timeless)
        )
    )
    control = (
        table(spark, folder, "orders")
        .select(key.alias("order_key"), "o_orderdate", F.explode(sent).alias("r"))
        .select(
            "order_key",
            F.col("r.s").alias("statistics"),
            (F.col("o_orderdate") + F.make_dt_interval(days=F.col("r.days"))).alias("ts"),
        )
    )
    return render_key(R.latest_declared(control, KEYS, missing="quarantine"))


def latest_declared(spark: SparkSession, folder: str) -> DataFrame:
    """Declared counts of the newest announcements, by time and sequence number."""
    return render_key(R.latest_declared(_revised_control(spark, folder), KEYS, order_by=("ts", "seq")))


def merge_control(spark: SparkSession, folder: str) -> DataFrame:
    """Base announcements merged with updates for half of the orders, the market entry
    of the result taken out and put back for none."""
    base = _sketchy_control(spark, folder)
    key = F.col("o_orderkey")
    update = (
        table(spark, folder, "orders")
        .where(key % 2 == 0)
        .select(
            key.alias("order_key"),
            F.when(key % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("new-"), (key % 10).cast("string"))).alias("fo_name"),
            S.build_statistics({TRADE: F.lit(100) + key % 3, "OTHER_DATA": key % 2}).alias("statistics"),
        )
    )
    merged = counting.merge_control(base, update, KEYS, remove=("OTHER_DATA",))
    return render_key(counting.declared_counts(counting.control_profile(merged))).drop("ts")


def reconcile_status(spark: SparkSession, folder: str) -> DataFrame:
    return render_key(R.reconcile(control(spark, folder), data(spark, folder), KEYS))


def reconcile_summary(spark: SparkSession, folder: str) -> DataFrame:
    return R.status_summary(R.reconcile(control(spark, folder), data(spark, folder), KEYS))


def completion_delta(spark: SparkSession, folder: str) -> DataFrame:
    return render_key(R.completion_delta(control(spark, folder), data(spark, folder), KEYS))


def completed_notifications(spark: SparkSession, folder: str) -> DataFrame:
    done = R.completed(R.reconcile(control(spark, folder), data(spark, folder), KEYS))
    return R.notifications(render_key(done))


def data_without_control(spark: SparkSession, folder: str) -> DataFrame:
    return render_key(R.data_without_control(control(spark, folder), data(spark, folder), KEYS))


def control_without_data(spark: SparkSession, folder: str) -> DataFrame:
    return render_key(R.control_without_data(control(spark, folder), data(spark, folder), KEYS))


def dedup_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    unique = R.dedup_data(data(spark, folder), KEYS)
    return render_key(R.reconcile(control(spark, folder), unique, KEYS))


def published_status(spark: SparkSession, folder: str) -> DataFrame:
    """Line items published as encoded topics with their true totals, read back and reconciled."""
    topics = new_table_path(spark, "delivery")
    # Encoding is worth more than a shuffle: a table of few row groups would be encoded in as few tasks.
    items = data(spark, folder).repartition(spark.sparkContext.defaultParallelism)
    publish_delivery(render_key(items), F.lit("fo-0"), "parquet", topics)
    control_in, _ = codec.quarantine(read_control(spark, "parquet", f"{topics}/{M.CONTROL_TOPIC}", streaming=False))
    data_in, _ = codec.quarantine(read_data(spark, "parquet", f"{topics}/{M.DATA_TOPIC}", streaming=False))
    return R.reconcile(control_in, data_in)
