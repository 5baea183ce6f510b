"""WARC archives: monolithic gzip files, normalised to one gzip member per record with an offset index.

``write_archives`` writes each partition's records as one or more whole-file gzip streams.
``normalise`` inflates such a stream once, in pieces, rewrites every record as a member of
its own and writes a sidecar index (page id, offset, length) beside the new file.
``read_records`` seeks to each indexed member and reads its record back. Files go to the
shared folder through Arrow's file systems, under names no other attempt uses, and only
files that a finished task reported are read.

Of records with equal payloads of ``revisit_bytes`` or more the one with the largest
page_id is the response and the others revisit it; smaller ones are all responses. Which
it is comes from an aggregation by digest, so a payload that a third of all pages share
costs one partial row per task.

Defined results: null html counts as an empty payload; a null page_id is a response unless
a larger (non-null) id has its payload, and is written without an id; rows that repeat both
page_id and payload of the response are responses too; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F

from ..session import new_table_path
from .common import durable

REVISIT_BYTES = 1000
# A file is closed once it holds this many bytes of records.
FILE_BYTES = 64 << 20
PIECE = 1 << 20


def _open(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path)


def with_record_types(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The pages with payload digest and length, record_type and refers_to."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.col("url"), F.lit("")).alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).withColumns(
        {
            "payload_digest": F.sha1(F.col("html").cast("binary")),
            "payload_bytes": F.octet_length("html").cast("bigint"),
        }
    )
    responses = (
        rows.where(F.col("payload_bytes") >= revisit_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_response"))
    )
    revisits = F.col("_response").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("_response")))
    return rows.join(
        responses,
        (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") >= revisit_bytes),
        "left",
    ).select(
        "page_id",
        "url",
        F.when(~F.coalesce(revisits, F.lit(False)), F.col("html")).alias("html"),
        F.when(F.coalesce(revisits, F.lit(False)), "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("_response")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
    )


def _record(row: dict) -> bytes:
    """One WARC record. A revisit has no block: digest, length and target stand in its header."""
    block = (row["html"] or "").encode() if row["record_type"] == "response" else b""
    head = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Target-URI": " ".join(row["url"].split()),
        "WARC-Payload-Digest": f"sha1:{row['payload_digest']}",
        "X-Payload-Length": row["payload_bytes"],
        "X-Page-ID": row["page_id"],
        "X-Refers-To-Page": row["refers_to"],
        "Content-Length": len(block),
    }
    lines = [f"{name}: {value}" for name, value in head.items() if value is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write monolithic archives; per file: its path and its number of records."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        sink = deflater = None
        size = count = 0
        paths, counts = [], []

        def close():
            sink.write(deflater.flush())
            sink.close()
            counts.append(count)

        for batch in batches:
            for row in batch.to_pylist():
                if sink is None:
                    name = f"mono-{uuid.uuid4().hex}.warc.gz"
                    sink, deflater = system.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(6, wbits=31)
                    paths.append(f"{folder}/{name}")
                    size = count = 0
                record = _record(row)
                sink.write(deflater.compress(record))
                size, count = size + len(record), count + 1
                if size >= FILE_BYTES:
                    close()
                    sink = None
        if sink is not None:
            close()
        yield pa.RecordBatch.from_pydict({"path": paths, "records": counts}, schema=fields)

    fields = pa.schema([("path", pa.string()), ("records", pa.int64())])
    return records.mapInArrow(work, "path string, records bigint")


def _inflated(source) -> Iterator[bytes]:
    """The contents of a gzip file of any number of members, in pieces."""
    inflater = zlib.decompressobj(wbits=31)
    while piece := source.read(PIECE):
        while piece:
            yield inflater.decompress(piece)
            piece = inflater.unused_data
            if inflater.eof:
                inflater = zlib.decompressobj(wbits=31)


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, record bytes) of a stream of records; holds one record at a time."""
    buffer = bytearray()

    def fill(needed) -> bool:
        for piece in pieces:
            buffer.extend(piece)
            if needed():
                return True
        return needed()

    while bool(buffer) or fill(lambda: bool(buffer)):
        end = buffer.find(b"\r\n\r\n")
        while end < 0:
            if not fill(lambda: buffer.find(b"\r\n\r\n") >= 0):
                raise ValueError("a record's header is cut off")
            end = buffer.find(b"\r\n\r\n")
        lines = bytes(buffer[:end]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        header = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        total = end + 4 + int(header["Content-Length"]) + 4
        if len(buffer) < total and not fill(lambda: len(buffer) >= total):
            raise ValueError("a record's block is cut off")
        yield header, bytes(buffer[:total])
        del buffer[:total]


def normalise(archives: DataFrame) -> DataFrame:
    """One gzip member per record; per file: paths of the new archive and its index, number of records."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"archive": [], "index": [], "records": []}
            for path in batch.column(0).to_pylist():
                system, source_path = _open(path)
                stem = f"{path.rsplit('/', 1)[0]}/members-{uuid.uuid4().hex}"
                own = _open(stem)[1]
                offset = count = 0
                with (
                    system.open_input_stream(source_path, compression=None) as source,
                    system.open_output_stream(f"{own}.warc.gz", compression=None) as archive,
                    system.open_output_stream(f"{own}.index", compression=None) as index,
                ):
                    for header, record in split_records(_inflated(source)):
                        deflater = zlib.compressobj(6, wbits=31)
                        member = deflater.compress(record) + deflater.flush()
                        archive.write(member)
                        entry = [header.get("X-Page-ID"), offset, len(member)]
                        index.write((json.dumps(entry) + "\n").encode())
                        offset, count = offset + len(member), count + 1
                out["archive"].append(f"{stem}.warc.gz")
                out["index"].append(f"{stem}.index")
                out["records"].append(count)
            yield pa.RecordBatch.from_pydict(out, schema=fields)

    fields = pa.schema([("archive", pa.string()), ("index", pa.string()), ("records", pa.int64())])
    return archives.select("path").mapInArrow(work, "archive string, index string, records bigint")


def read_records(normalised: DataFrame) -> DataFrame:
    """Each indexed record, read by its offset; a payload that doesn't have its digest is an error."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive_path, index_path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                system, archive_file = _open(archive_path)
                with (
                    system.open_input_stream(_open(index_path)[1], compression=None) as index,
                    system.open_input_file(archive_file) as archive,
                ):
                    rows = []
                    for line in io.TextIOWrapper(index, encoding="utf-8"):
                        _, offset, length = json.loads(line)
                        archive.seek(offset)
                        rows.append(_row(zlib.decompress(archive.read(length), wbits=31)))
                        if len(rows) == 2000:
                            yield pa.RecordBatch.from_pylist(rows, schema=fields)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, schema=fields)

    def _row(record: bytes) -> dict:
        header, whole = next(split_records(iter([record])))
        block = whole[-4 - int(header["Content-Length"]) : -4]
        digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
        if header["WARC-Type"] == "response" and hashlib.sha1(block).hexdigest() != digest:
            raise ValueError(f"page {header.get('X-Page-ID')}: payload and digest differ")
        number = {name: int(header[name]) if name in header else None for name in ("X-Page-ID", "X-Refers-To-Page")}
        response = header["WARC-Type"] == "response"
        return {
            "page_id": number["X-Page-ID"],
            "url": header["WARC-Target-URI"],
            "payload_bytes": len(block) if response else int(header["X-Payload-Length"]),
            "payload_digest": digest,
            "record_type": header["WARC-Type"],
            "refers_to": number["X-Refers-To-Page"],
            "payload": block if response else None,
        }

    fields = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    schema = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint, payload binary"
    )
    return normalised.select("archive", "index").mapInArrow(work, schema)


def archive_pages(pages: DataFrame, folder: str | None = None, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write the pages as archives, normalise them, and return the table of normalised files."""
    folder = folder or new_table_path(pages.sparkSession, "warc")
    archives = durable(write_archives(with_record_types(pages, revisit_bytes), folder), "warc-files")
    # A row is a file: deal them out one by one.
    files = archives.repartition(max(1, archives.count()))
    return durable(normalise(files), "warc-normalised")
