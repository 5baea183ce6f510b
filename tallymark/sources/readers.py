"""Control and data sources: message topics on Kafka or in files, and plain message tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import messages as M
from .codec import CONTROL, DATA, JSON_DECODERS, TOPICS, MessageCodec, decode_messages

KAFKA = "kafka"
DEFAULT_BROKERS = "localhost:9092"

SCHEMAS = {CONTROL: M.CONTROL_SCHEMA, DATA: M.DATA_SCHEMA}


def kafka_source_options(
    topic: str,
    brokers: str = DEFAULT_BROKERS,
    streaming: bool = True,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Kafka reader options. A stream starts at the newest offset, a batch reads the whole topic.

    Worth setting in ``extra`` on a busy topic: ``minPartitions`` splits large topic
    partitions over more tasks, ``maxOffsetsPerTrigger`` bounds a micro-batch.
    """
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "latest" if streaming else "earliest",
        **(extra or {}),
    }


def read_envelopes(
    spark: SparkSession,
    topic: str,
    format: str = KAFKA,
    path: str | None = None,
    streaming: bool = True,
    brokers: str = DEFAULT_BROKERS,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw envelopes (key, value, topic, timestamp) of a topic, from Kafka or from a folder of files."""
    reader = (spark.readStream if streaming else spark.read).format(format)
    if format == KAFKA:
        reader = reader.options(**kafka_source_options(topic, brokers, streaming, options))
        return reader.load().select("key", "value", "topic", "timestamp", "partition", "offset")
    return reader.schema(M.ENVELOPE_SCHEMA).options(**(options or {})).load(path)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Give the time column the type watermarks need, whatever kind of timestamp it has."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def _read(
    spark: SparkSession,
    kind: str,
    format: str,
    path: str | None,
    streaming: bool,
    layout: str,
    decoders: MessageCodec,
    topic: str | None,
    brokers: str,
    options: Mapping[str, str] | None,
    types: Sequence[str],
) -> DataFrame:
    if layout == "envelope":
        raw = read_envelopes(spark, topic or TOPICS[kind], format, path, streaming, brokers, options)
        return decode_messages(raw, kind, decoders, types)
    if layout == "table":
        reader = (spark.readStream if streaming else spark.read).format(format)
        return event_time(reader.schema(SCHEMAS[kind]).options(**(options or {})).load(path))
    raise ValueError(f"layout must be envelope or table, not {layout!r}")


def read_control(
    spark: SparkSession,
    format: str = KAFKA,
    path: str | None = None,
    streaming: bool = True,
    layout: str = "envelope",
    decoders: MessageCodec = JSON_DECODERS,
    topic: str | None = None,
    brokers: str = DEFAULT_BROKERS,
    options: Mapping[str, str] | None = None,
    types: Sequence[str] = M.TYPES,
) -> DataFrame:
    """Control messages. ``layout="envelope"`` decodes topic bytes (see ``quarantine`` for the
    rejects), ``layout="table"`` reads files that already hold message columns."""
    return _read(spark, CONTROL, format, path, streaming, layout, decoders, topic, brokers, options, types)


def read_data(
    spark: SparkSession,
    format: str = KAFKA,
    path: str | None = None,
    streaming: bool = True,
    layout: str = "envelope",
    decoders: MessageCodec = JSON_DECODERS,
    topic: str | None = None,
    brokers: str = DEFAULT_BROKERS,
    options: Mapping[str, str] | None = None,
    types: Sequence[str] = M.TYPES,
) -> DataFrame:
    """Data messages; the arguments are those of ``read_control``."""
    return _read(spark, DATA, format, path, streaming, layout, decoders, topic, brokers, options, types)
