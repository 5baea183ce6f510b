"""The deliveries of ``orders`` and ``events`` as file streams, run until nothing is left.

Announcements are first written as an encoded topic of files and read back through
the decoder; line items and events stream straight from their tables. The queries
over ``Slices`` encode both topics and take them in several micro-batches, cut along time.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import messages as M
from ..operators import counting
from ..operators.reconcile import notifications
from ..session import frozen, new_table_path
from ..sources import codec
from ..sources.readers import read_control, read_data
from ..sources.writers import write_messages
from ..streaming import edges, run
from ..streaming.aggregate import completed_once, end_states, expiry
from ..streaming.late import read_judged, start_late_table
from ..streaming.snapshot import delivery_history, delivery_snapshot
from . import events, orders
from .delivery import consume_to_tables, publish_delivery
from .tables import table_stream


def _control_stream(spark: SparkSession, control: DataFrame) -> DataFrame:
    """Publish announcements as a topic of files and open it as a stream."""
    topic = new_table_path(spark, "ctrl")
    write_messages(codec.encode_messages(control, codec.CONTROL), M.CONTROL_TOPIC, "parquet", topic)
    good, _ = codec.quarantine(read_control(spark, "parquet", topic))
    return good


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


# A month of events comes in so many parts, each of so many days.
SLICES, SLICE_DAYS = 7, 5
SLICE = "slice"
ONE_FILE = {"maxFilesPerTrigger": "1"}


class Slices:
    """Rows as a folder of files that come in one after the other, a slice each, oldest first.

    The rows are written once, by slice, and given out from there, so that the order of the
    files is that of time, and a stream that takes one file a micro-batch has a micro-batch a slice.
    """

    def __init__(self, rows: DataFrame, name: str):
        spark = rows.sparkSession
        staged = new_table_path(spark, f"{name}-staged")
        self.path = new_table_path(spark, name)
        rows.write.partitionBy(SLICE).parquet(staged)
        self.staged = spark.read.schema(rows.schema).parquet(staged)

    def release(self, numbers) -> None:
        for number in numbers:
            own = self.staged.where(F.col(SLICE) == number).drop(SLICE)
            own.coalesce(1).write.mode("append").parquet(self.path)


def _day_slice(ts: str = "ts") -> Column:
    """The slice a day belongs to; rows without a time come first."""
    return F.coalesce(F.floor((F.dayofmonth(ts) - 1) / SLICE_DAYS).cast("int"), F.lit(0))


class EventTopics:
    """Control and data topics of the events, encoded, in slices of days."""

    def __init__(self, control: DataFrame, data: DataFrame):
        self.topics = [
            Slices(codec.encode_messages(rows.withColumn(SLICE, _day_slice()), kind, extra=(SLICE,)), name)
            for rows, kind, name in ((control, codec.CONTROL, "ctrl"), (data, codec.DATA, "data"))
        ]

    def release(self, numbers) -> None:
        for topic in self.topics:
            topic.release(numbers)

    def streams(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        control = read_control(spark, "parquet", self.topics[0].path, options=ONE_FILE)
        data = read_data(spark, "parquet", self.topics[1].path, options=ONE_FILE)
        return codec.quarantine(control)[0], codec.quarantine(data)[0]


def _day_topics(spark: SparkSession, folder: str) -> EventTopics:
    """Each user's day is a request."""
    control = events.render_key(events.control(spark, folder))
    known = events.data(spark, folder).where(F.col("type").isin(*M.TYPES))
    return EventTopics(control, events.render_key(known))


def _user_topics(spark: SparkSession, folder: str) -> EventTopics:
    """Each user is a request, whose records come in over the whole month."""

    def keyed(df: DataFrame) -> DataFrame:
        rest = [name for name in df.columns if name not in events.KEYS]
        return counting.with_message_key(df, "user_id").select(*M.KEYS, *rest)

    control = events.user_control(spark, folder).withColumn("fo_name", F.lit("fo-0"))
    known = events.data(spark, folder).where(F.col("type").isin(*M.TYPES))
    return EventTopics(keyed(control), keyed(known))


def _run_restarted(spark: SparkSession, topics, start) -> None:
    """Take the slices one a trigger, stop in the middle, and go on from the checkpoint."""
    for numbers in (range(0, SLICES // 2), range(SLICES // 2, SLICES)):
        topics.release(numbers)
        query = start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()


def _order_streams(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    control = _control_stream(spark, orders.render_key(orders.control(spark, folder)))
    items = orders.item_messages(table_stream(spark, folder, "lineitem"))
    return control, orders.render_key(items)


def _event_streams(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    control = _control_stream(spark, events.render_key(events.control(spark, folder)))
    records = events.event_messages(table_stream(spark, folder, "events"))
    return control, events.render_key(records)


def stream_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Status of every order after the streams ran dry; equals the batch result."""
    path, checkpoint = new_table_path(spark, "reconcile"), new_table_path(spark, "checkpoint")
    with run.state_store(spark, "rocksdb"):
        status = run.stream_reconcile(*_order_streams(spark, folder))
        _finish(run.start_table(status, path, checkpoint, "update"))
    return run.latest_state(spark, path).drop("last_ts")


def stream_completed(spark: SparkSession, folder: str) -> DataFrame:
    """Notices of completed orders, each once."""
    path, checkpoint = new_table_path(spark, "completed"), new_table_path(spark, "checkpoint")
    with run.state_store(spark, "hdfs"):
        done = run.stream_completed(*_order_streams(spark, folder))
        _finish(run.start_table(notifications(done), path, checkpoint, "update"))
    return run.read_changes(spark, path).drop("batch_id")


def stream_expiry(spark: SparkSession, folder: str) -> DataFrame:
    """End state of each user's day: complete, or expired after a day without a message."""
    path, checkpoint = new_table_path(spark, "expiry"), new_table_path(spark, "checkpoint")
    with run.state_store(spark, "rocksdb"):
        ended = run.stream_reconcile(*_event_streams(spark, folder), ttl=timedelta(days=1), delay="1 hour")
        _finish(run.start_table(ended, path, checkpoint))
    return run.read_changes(spark, path).drop("batch_id", "at")


def stream_end_states(spark: SparkSession, folder: str) -> DataFrame:
    """Final counts of each user's day a day after its last message, without Python."""
    path, checkpoint = new_table_path(spark, "ends"), new_table_path(spark, "checkpoint")
    with run.state_store(spark, "rocksdb"):
        ended = end_states(*_event_streams(spark, folder), ttl=timedelta(days=1), delay="1 hour")
        _finish(run.start_table(ended, path, checkpoint))
    return run.read_changes(spark, path).drop("batch_id").withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz"))


def stream_restarted(spark: SparkSession, folder: str) -> DataFrame:
    """Status of every user after micro-batches of days, a trigger each, with a restart among them."""
    path, checkpoint = new_table_path(spark, "restarted"), new_table_path(spark, "checkpoint")
    topics = _user_topics(spark, folder)
    with run.state_store(spark, "rocksdb"):
        _run_restarted(
            spark,
            topics,
            lambda: run.start_table(
                run.stream_reconcile(*topics.streams(spark)), path, checkpoint, "update", every="0 seconds"
            ),
        )
    return run.latest_state(spark, path).drop("last_ts")


def state_history(spark: SparkSession, folder: str) -> DataFrame:
    """How every user stood after each micro-batch of days that touched it, from the state's change feed."""
    path, checkpoint = new_table_path(spark, "history"), new_table_path(spark, "checkpoint")
    topics = _user_topics(spark, folder)
    with run.state_store(spark, "hdfs"):
        _run_restarted(
            spark,
            topics,
            lambda: run.start_table(
                run.stream_reconcile(*topics.streams(spark)), path, checkpoint, "update", every="0 seconds"
            ),
        )
    history = delivery_history(spark, checkpoint)
    return history.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz"))


def stream_session_expiry(spark: SparkSession, folder: str) -> DataFrame:
    """End state of each user's day once it was idle for a day: complete or expired, without Python."""
    path, checkpoint = new_table_path(spark, "sessions"), new_table_path(spark, "checkpoint")
    topics = _day_topics(spark, folder)
    topics.release(range(SLICES))
    with run.local_sessions(spark):
        ended = expiry(*topics.streams(spark), ttl=timedelta(days=1), delay="1 hour")
        _finish(run.start_table(ended, path, checkpoint))
    return run.read_changes(spark, path).drop("batch_id", "last_ts", "has_control", "has_data")


def stream_completed_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Notices of completed user days, each once, from states that the watermark drops."""
    path, checkpoint = new_table_path(spark, "bounded"), new_table_path(spark, "checkpoint")
    topics = _day_topics(spark, folder)
    topics.release(range(SLICES))
    with run.local_sessions(spark, "hdfs"):
        done = completed_once(*topics.streams(spark), ttl=timedelta(days=1), delay="1 hour")
        notices = notifications(done).select(*M.KEYS, "message")
        _finish(run.start_table(notices, path, checkpoint))
    return run.read_changes(spark, path).drop("batch_id")


def stream_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Days on which a user turned complete or was so no more, from a stream of daily snapshots."""
    path, checkpoint = new_table_path(spark, "edges"), new_table_path(spark, "checkpoint")
    history = frozen(events.daily_history(spark, folder), "daily").withColumn(
        "snapshot_ts", F.col("snapshot_ts").cast("timestamp")
    )
    # What comes after the last snapshot is another day's business: a row of no request
    # moves the watermark to the end of the last day and no further.
    beat = history.agg((F.max("snapshot_ts") + F.expr("INTERVAL 1 DAY")).alias("snapshot_ts")).select(
        *[F.lit(None).cast(history.schema[name].dataType).alias(name) for name in events.USER],
        "snapshot_ts",
        *[F.lit(0).cast("bigint").alias(M.delta_column(t)) for t in M.TYPES],
        F.lit(SLICES).alias(SLICE),
    )
    slices = Slices(history.withColumn(SLICE, _day_slice("snapshot_ts")).unionByName(beat), "snapshots")
    slices.release(range(SLICES + 1))
    stream = spark.readStream.schema(history.schema).options(**ONE_FILE).parquet(slices.path)
    with run.state_store(spark, "hdfs"):
        _finish(run.start_table(edges.stream_edges(stream, events.USER), path, checkpoint))
    found = run.read_changes(spark, path).drop("batch_id").where(F.col("user_id").isNotNull())
    found = found.withColumn("snapshot_ts", F.col("snapshot_ts").cast("timestamp_ntz"))
    return counting.with_message_key(found, "user_id").select(*M.KEYS, "snapshot_ts", "edge")


def consumed_notices(spark: SparkSession, folder: str) -> DataFrame:
    """The whole consumer: both topics published, read as streams, and a notice kept for each completed user."""
    path, checkpoint = new_table_path(spark, "consumed"), new_table_path(spark, "checkpoint")
    known = events.data(spark, folder).where(F.col("type").isin(*M.TYPES))
    records = counting.with_message_key(known.drop("day"), "user_id").select(*M.KEYS, "type", "id", "value", "ts")
    publish_delivery(records, F.lit("fo-0"), "parquet", f"{path}/topics")
    for query in consume_to_tables(
        spark, checkpoint, f"{path}/out", "parquet", f"{path}/topics", ttl=None, every=None, options={"maxFilesPerTrigger": "1000"}
    ):
        _finish(query)
    return run.read_changes(spark, f"{path}/out/notices").drop("batch_id")


# Every so many events come in two slices after their own.
DELAYED_EVENTS, DELAYED_SLICES = 50, 2


def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the events, and by how much those are late that come in two slices after their own."""
    path, checkpoint = new_table_path(spark, "judged"), new_table_path(spark, "checkpoint")
    delayed = F.when(F.col("seq") % DELAYED_EVENTS == 0, F.lit(DELAYED_SLICES)).otherwise(F.lit(0))
    arrival = F.least(_day_slice() + delayed, F.lit(SLICES - 1))
    records = events.data(spark, folder).withColumn("type", F.lit(M.TYPES[0]))
    topic = Slices(
        codec.encode_messages(events.render_key(records).withColumn(SLICE, arrival), codec.DATA, extra=(SLICE,)), "data"
    )

    def start() -> StreamingQuery:
        arrived = codec.quarantine(read_data(spark, "parquet", topic.path, options=ONE_FILE))[0]
        return start_late_table(arrived, path, checkpoint, delay=timedelta(hours=1), every="0 seconds")

    _run_restarted(spark, topic, start)
    return read_judged(spark, path).select(*M.KEYS, "id", F.col("late_by_us").isNotNull().alias("late"), "late_by_us")


def state_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The keyed state a finished reconciliation of events left in its checkpoint."""
    path, checkpoint = new_table_path(spark, "state"), new_table_path(spark, "checkpoint")
    with run.state_store(spark, "hdfs"):
        status = run.stream_reconcile(*_event_streams(spark, folder))
        _finish(run.start_table(status, path, checkpoint, "update"))
    snapshot = delivery_snapshot(spark, checkpoint)
    return snapshot.withColumn("last_ts", F.col("last_ts").cast("timestamp_ntz"))
