"""The two ends of a delivery as whole jobs: publishing one and consuming one."""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Mapping, Sequence
from datetime import timedelta
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import messages as M
from ..operators.counting import control_totals
from ..session import build_session
from ..sources import codec
from ..sources.readers import DEFAULT_BROKERS, KAFKA, read_control, read_data
from ..sources.writers import write_messages
from ..streaming.run import start_notifier, start_table

FORMATS = ("json", "protobuf-arrow", "protobuf-jvm")


def codecs(name: str) -> tuple[codec.MessageCodec, codec.MessageCodec]:
    """Encoders and decoders of a wire format by name."""
    if name == "json":
        return codec.JSON_ENCODERS, codec.JSON_DECODERS
    from ..sources import protobuf

    if name == "protobuf-arrow":
        return protobuf.arrow_encoders(), protobuf.arrow_decoders()
    if name == "protobuf-jvm":
        return protobuf.jvm_encoders(), protobuf.jvm_decoders()
    raise ValueError(f"wire format must be one of {', '.join(FORMATS)}, not {name!r}")


def publish_delivery(
    data: DataFrame,
    fo_name: Column,
    format: str = KAFKA,
    path: str | None = None,
    brokers: str = DEFAULT_BROKERS,
    encoders: codec.MessageCodec = codec.JSON_ENCODERS,
    options: Mapping[str, str] | None = None,
    types: Sequence[str] = M.TYPES,
    rejects: str | None = None,
    mode: str = "append",
    delivery_id: str | None = None,
) -> None:
    """Announce every request of a data frame with its true totals, then send its records.

    With a file format, ``path`` is the folder that gets one subfolder per topic, and
    ``mode="overwrite"`` makes a repeated run replace what an earlier one left. Rows that
    the wire format cannot hold are written with their reason to a parquet table per
    topic under ``rejects``; without such a folder they fail the job. Announcements of
    records that have no time get the time of the job.

    A ``delivery_id`` makes a delivery to files repeatable: each run writes to folders of
    its own, and the last thing it writes is a line in the table ``path/deliveries`` that
    names them. ``read_delivered`` reads what that table names, one run for each id, so a
    run that died anywhere, or a delivery that was published again, adds nothing.
    """
    folder = ""
    if delivery_id is not None:
        if format == KAFKA:
            raise ValueError("a topic on Kafka cannot take back a delivery; delivery_id is for files")
        spark = data.sparkSession
        if not _deliveries(spark, path).where(F.col(_DELIVERY) == delivery_id).isEmpty():
            return
        attempt = uuid.uuid4().hex
        folder = f"/{_DELIVERY}={quote(delivery_id, safe='')}/{_ATTEMPT}={attempt}"
    announced = control_totals(data, types=types, ts="ts" if "ts" in data.columns else None)
    time = F.coalesce("ts", F.current_timestamp()) if "ts" in data.columns else F.current_timestamp()
    announced = announced.withColumns({"fo_name": fo_name, "ts": time})
    for kind, frame in ((codec.CONTROL, announced), (codec.DATA, data)):
        topic = codec.TOPICS[kind]
        if rejects:
            frame, bad = codec.screen_messages(frame, kind, encoders, types)
            bad.write.mode(mode).parquet(f"{rejects}/{topic}{folder}")
        write_messages(
            codec.encode_messages(frame, kind, encoders, types=types, invalid="fail"),
            topic,
            format,
            path and f"{path}/{topic}{folder}",
            brokers,
            options,
            mode=mode,
        )
    if delivery_id is not None:
        done = spark.range(1).select(F.lit(delivery_id).alias(_DELIVERY), F.lit(attempt).alias(_ATTEMPT))
        done.write.mode("append").parquet(f"{path}/{_COMMITTED}")


# The table of published deliveries, and the two folder levels that a run writes to.
_COMMITTED, _DELIVERY, _ATTEMPT = "deliveries", "delivery", "attempt"


def _deliveries(spark: SparkSession, path: str) -> DataFrame:
    """The run that counts for each published delivery: one, also if two were published at once."""
    try:
        lines = spark.read.schema(f"{_DELIVERY} string, {_ATTEMPT} string").parquet(f"{path}/{_COMMITTED}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], f"{_DELIVERY} string, {_ATTEMPT} string")
    return lines.groupBy(_DELIVERY).agg(F.min(_ATTEMPT).alias(_ATTEMPT))


def read_delivered(
    spark: SparkSession,
    path: str,
    kind: str,
    format: str = "parquet",
    decoders: codec.MessageCodec = codec.JSON_DECODERS,
    options: Mapping[str, str] | None = None,
    types: Sequence[str] = M.TYPES,
) -> DataFrame:
    """Messages of one kind of all deliveries published with a ``delivery_id``, each delivery once.

    Folders are pruned by the table of deliveries where Spark finds that worthwhile. See
    ``quarantine`` for rejects; ``delivery`` names the delivery.
    """
    schema = T.StructType([*M.ENVELOPE_SCHEMA.fields, *(T.StructField(c, T.StringType()) for c in (_DELIVERY, _ATTEMPT))])
    envelopes = spark.read.format(format).schema(schema).options(**(options or {})).load(f"{path}/{codec.TOPICS[kind]}")
    delivered = envelopes.join(_deliveries(spark, path), [_DELIVERY, _ATTEMPT], "left_semi").drop(_ATTEMPT)
    return codec.decode_messages(delivered, kind, decoders, types)


def _decoded(
    spark: SparkSession,
    format: str,
    path: str | None,
    brokers: str,
    decoders: codec.MessageCodec,
    options: Mapping[str, str] | None,
    types: Sequence[str],
    missing: str = "zero",
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Good and rejected rows of the two topics."""
    topics = {}
    for kind, read in ((codec.CONTROL, read_control), (codec.DATA, read_data)):
        folder = path and f"{path}/{codec.TOPICS[kind]}"
        decoded = read(spark, format, folder, decoders=decoders, brokers=brokers, options=options, types=types)
        good, bad = codec.quarantine(decoded)
        if kind == codec.CONTROL and missing == "quarantine":
            bad = bad.unionByName(codec.incomplete_announcements(decoded, types))
        topics[kind] = good, bad
    return topics


def _ordered(format: str) -> str | None:
    """The column that orders announcements of equal time."""
    return "offset" if format == KAFKA else None


def consume(
    spark: SparkSession,
    checkpoint: str,
    format: str = KAFKA,
    path: str | None = None,
    brokers: str = DEFAULT_BROKERS,
    decoders: codec.MessageCodec = codec.JSON_DECODERS,
    ttl: timedelta | None = timedelta(seconds=20),
    every: str | None = "1 second",
    options: Mapping[str, str] | None = None,
    types: Sequence[str] = M.TYPES,
    rows: int = 10,
) -> StreamingQuery:
    """Show notices on the console: ``rows`` of each micro-batch, without what cannot be decoded.

    ``consume_to_tables`` keeps all notices and all rejects.
    """
    topics = _decoded(spark, format, path, brokers, decoders, options, types)
    good = [topics[kind][0] for kind in (codec.CONTROL, codec.DATA)]
    return start_notifier(
        *good, checkpoint=checkpoint, ttl=ttl, every=every, rows=rows, types=types, seq=_ordered(format)
    )


def consume_to_tables(
    spark: SparkSession,
    checkpoint: str,
    output: str,
    format: str = KAFKA,
    path: str | None = None,
    brokers: str = DEFAULT_BROKERS,
    decoders: codec.MessageCodec = codec.JSON_DECODERS,
    ttl: timedelta | None = timedelta(seconds=20),
    every: str | None = "1 second",
    options: Mapping[str, str] | None = None,
    types: Sequence[str] = M.TYPES,
    missing: str = "zero",
    engine: str = "state",
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two queries: every notice to ``output/notices``, every undecodable envelope to ``output/rejects``.

    Both tables are read with ``read_changes``; a rejected envelope has its topic, bytes and reason.
    With ``missing="quarantine"`` announcements that lack a type are among the rejects, and
    their requests are not complete; ``engine`` is that of ``start_notifier``.
    """
    topics = _decoded(spark, format, path, brokers, decoders, options, types, missing)
    bad = [rejected.withColumn("topic", F.lit(codec.TOPICS[kind])) for kind, (_, rejected) in topics.items()]
    rejects = start_table(bad[0].unionByName(bad[1]), f"{output}/rejects", f"{checkpoint}/rejects", every=every)
    notices = start_notifier(
        topics[codec.CONTROL][0],
        topics[codec.DATA][0],
        checkpoint=f"{checkpoint}/notices",
        ttl=ttl,
        every=every,
        output=f"{output}/notices",
        types=types,
        seq=_ordered(format),
        missing=missing,
        engine=engine,
    )
    return notices, rejects


def main() -> None:
    """Consumer as an application: ``spark-submit`` it with the Kafka connector on the class path."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--brokers", default=DEFAULT_BROKERS)
    parser.add_argument("--checkpoint", required=True, help="folder all executors share")
    parser.add_argument("--output", required=True, help="folder of the notices and rejects tables")
    parser.add_argument("--wire", default="protobuf-jvm", choices=FORMATS)
    parser.add_argument("--ttl-seconds", type=float, default=20)
    parser.add_argument("--every", default="1 second")
    parser.add_argument("--missing", default="zero", choices=("zero", "fail", "quarantine"))
    parser.add_argument("--engine", default="state", choices=("state", "sessions"))
    chosen = parser.parse_args()
    _, decoders = codecs(chosen.wire)
    spark = build_session("tallymark-consumer")
    consume_to_tables(
        spark,
        chosen.checkpoint,
        chosen.output,
        brokers=chosen.brokers,
        decoders=decoders,
        ttl=timedelta(seconds=chosen.ttl_seconds),
        every=chosen.every,
        missing=chosen.missing,
        engine=chosen.engine,
    )
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
