"""Sinks: message topics on Kafka or in files, and the console."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .readers import DEFAULT_BROKERS, KAFKA

# Fixed producer settings of a sink that sends every record at once and never retries.
UNBATCHED_SINK = {
    "kafka.acks": "all",
    "kafka.retries": "0",
    "kafka.batch.size": "10",
    "kafka.linger.ms": "0",
}


def kafka_sink_options(
    topic: str, brokers: str = DEFAULT_BROKERS, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    """Kafka writer options: every in-sync replica acknowledges; ``extra`` adds or overrides
    producer settings (``UNBATCHED_SINK`` for lowest latency and lowest throughput)."""
    return {"kafka.bootstrap.servers": brokers, "topic": topic, "kafka.acks": "all", **(extra or {})}


def write_messages(
    envelopes: DataFrame,
    topic: str,
    format: str = KAFKA,
    path: str | None = None,
    brokers: str = DEFAULT_BROKERS,
    options: Mapping[str, str] | None = None,
    checkpoint: str | None = None,
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery | None:
    """Write envelopes to a topic; a streaming frame starts a query and returns it.

    Without ``every`` the streaming query takes what is available and stops.
    """
    if format == KAFKA:
        settings = kafka_sink_options(topic, brokers, options)
        rows = envelopes.select("key", "value")
    else:
        settings = {**(options or {}), "path": path}
        rows = envelopes
    if not envelopes.isStreaming:
        rows.write.format(format).options(**settings).mode(mode).save()
        return None
    writer = rows.writeStream.format(format).options(**settings).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.outputMode("append").trigger(**trigger).start()


def write_console(
    df: DataFrame,
    rows: int = 10,
    every: str | None = "1 second",
    checkpoint: str | None = None,
    output_mode: str = "append",
) -> StreamingQuery | None:
    """Print the first rows of each micro-batch, or of the frame if it is not streaming."""
    if not df.isStreaming:
        df.show(rows, truncate=False)
        return None
    writer = df.writeStream.format("console").option("numRows", rows).option("truncate", "false")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.outputMode(output_mode).trigger(**trigger).start()
