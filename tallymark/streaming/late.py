"""Rows that come too late: told, not silently dropped."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery


def lateness(ts: Column, newest: Column, delay: timedelta) -> Column:
    """Microseconds by which a row is behind the watermark; null if it is not.

    The watermark is the newest time of earlier micro-batches less ``delay``, in whole
    milliseconds, and a row at the watermark is late. Spark's stateful steps drop late rows
    by the watermark of one micro-batch earlier, so whatever they drop is late here too.
    """
    delay_us = int(delay / timedelta(microseconds=1))
    watermark = F.floor((F.unix_micros(newest) - F.lit(delay_us)) / 1000) * 1000
    behind = watermark - F.unix_micros(ts)
    return F.when(behind >= 0, behind)


def start_late_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "ts",
    delay: timedelta = timedelta(seconds=5),
    every: str | None = None,
) -> StreamingQuery:
    """Write every row with ``late_by_us`` (null: in time) as one ``batch_id`` partition a micro-batch.

    A row is judged by its own time against the newest time of the micro-batches
    before its own, which is written beside each of them: a micro-batch that
    runs again, or a query that starts again, judges alike. Rows without a time are in time.
    Read it with ``read_judged``.
    """

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            newest = None
        else:
            newest = spark.read.parquet(f"{path}/newest/batch_id={batch_id - 1}").first()["newest"]
        seen = Observation()
        own = batch.observe(seen, F.max(ts).alias("newest"))
        late_by = lateness(F.col(ts), F.lit(newest).cast("timestamp"), delay)
        own.withColumn("late_by_us", late_by).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        here = seen.get["newest"]
        reached = max((t for t in (newest, here) if t is not None), default=None)
        mark = spark.range(1).select(F.lit(reached).cast("timestamp").alias("newest"))
        mark.write.mode("overwrite").parquet(f"{path}/newest/batch_id={batch_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(judge).trigger(**trigger).start()


def read_judged(spark, path: str) -> DataFrame:
    """Everything ``start_late_table`` wrote, with the micro-batch it came in."""
    return spark.read.parquet(f"{path}/rows").withColumn("batch_id", F.col("batch_id").cast("bigint"))
