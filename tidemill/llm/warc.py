"""Operator 2: WARC archives of pages, and a normaliser for monolithic gzip archives.

``write_archives`` writes each partition as one archive, all records in a single gzip stream.  ``normalise_archives``
inflates such a stream once, in pieces, writes every record again as a gzip member of its own and puts a sidecar index
beside the file (one line for each record: offset, length, type, record id).  ``read_archives`` fetches records by the index.

Pages with equal payloads of at least 100 bytes are stored once: the one with the smallest page_id is a response, the
others are revisits that name it.  All files lie in the shared folder, so any executor can go on with them; a file counts
only once the task that wrote it has ended, as later steps take the paths from a written table.

Cases: a null html is an empty payload; a null url is left out of the record; rows that share the smallest page_id are
responses all of them; a null page_id sorts behind all others; equal payloads whose page_ids are all null are responses;
an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.registry import query, table
from tidemill.llm.staging import shared_folder, staged

LEAST = 100
#: Digests with several pages up to this number are broadcast; more are joined by a shuffle.
BROADCAST_DIGESTS = 200_000
PIECE = 1 << 18
EMIT_BYTES = 4 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def record_types(pages: DataFrame) -> DataFrame:
    """Pages with ``payload_digest, payload_bytes, refers_to``; the last is null for responses."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    rows = rows.withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    groups = rows.where(F.col("payload_bytes") >= LEAST).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    several = staged(groups.where("n > 1 and first is not null").select("payload_digest", "first"), "warc-several")
    few = several.count() <= BROADCAST_DIGESTS
    joined = rows.join(F.broadcast(several) if few else several, "payload_digest", "left")
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")


def _record(kind: str, page: object, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", "WARC-Date: 1970-01-01T00:00:00Z", *[f"{k}: {v}" for k, v in headers], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page, url, html: bytes, digest: str, refers) -> bytes:
    """One record; a revisit holds the HTTP head only."""
    headers = [("WARC-Target-URI", "".join(url.split()))] if url else []
    headers += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(len(html))), ("Content-Type", "application/http; msgtype=response")]
    if refers is None:
        return _record("response", page, headers, HTTP + html)
    headers += [("WARC-Refers-To", f"<urn:page:{refers}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return _record("revisit", page, headers, HTTP)


def _open(folder: str):
    where, path = fs.FileSystem.from_uri(folder)
    where.create_dir(path, recursive=True)
    return where, path


def write_archives(typed: DataFrame, folder: str) -> DataFrame:
    """Write each partition as one gzip stream; ``path, records``."""

    def batches(stream):
        where, base = _open(folder)
        path, out, packer, count = f"{base}/{uuid.uuid4().hex}.warc.gz", None, None, 0
        for batch in stream:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "payload_digest", "refers_to"))):
                if out is None:
                    out, packer = where.open_output_stream(path, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                page, url, html, digest, refers = row
                out.write(packer.compress(page_record(page, url, html.encode(), digest, refers)))
                count += 1
        if out is not None:
            out.write(packer.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count])], ["path", "records"])

    return typed.select("page_id", "url", "html", "payload_digest", "refers_to").mapInArrow(batches, "path string, records long")


def inflated(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip file, one or many members, in pieces of bounded size."""
    unpacker, begun = zlib.decompressobj(31), False
    for piece in pieces:
        while piece:
            if unpacker.eof:
                unpacker, begun = zlib.decompressobj(31), False
            begun = True
            yield unpacker.decompress(piece, PIECE)
            piece = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
    if begun and not unpacker.eof:
        raise ValueError("the gzip stream is cut short")


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and all bytes of each record of an inflated archive; one record is held at a time."""
    held = bytearray()
    ended = False

    def more() -> bool:
        nonlocal ended
        piece = next(pieces, None)
        ended = piece is None
        held.extend(piece or b"")
        return not ended

    while True:
        while (at := held.find(b"\r\n\r\n")) < 0 and more():
            pass
        if at < 0:
            if held.strip():
                raise ValueError("the archive ends inside a record's head")
            return
        headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in held[:at].decode().split("\r\n")[1:])}
        size = at + 4 + int(headers["content-length"]) + 4
        while len(held) < size and more():
            pass
        if len(held) < size:
            raise ValueError("the archive ends inside a record")
        yield headers, bytes(held[:size])
        del held[:size]


def _pieces(where, path: str) -> Iterator[bytes]:
    with where.open_input_stream(path, compression=None) as source:
        while piece := source.read(PIECE):
            yield piece


def normalise_archives(archives: DataFrame, folder: str, files: int) -> DataFrame:
    """Rewrite monolithic archives (``path``), each record a member of its own, with a sidecar; ``path, index, records``."""

    def batches(stream):
        where, base = _open(folder)
        for batch in stream:
            for source in batch.column("path").to_pylist():
                path, at, lines = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, []
                with where.open_output_stream(path, compression=None) as out:
                    for headers, record in split_records(inflated(_pieces(where, source))):
                        packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                        member = packer.compress(record) + packer.flush()
                        out.write(member)
                        lines.append(f"{at} {len(member)} {headers['warc-type']} {headers['warc-record-id']}\n")
                        at += len(member)
                index = f"{path}.idx"
                with where.open_output_stream(index, compression=None) as out:
                    out.write("".join(lines).encode())
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([index]), pa.array([len(lines)])], ["path", "index", "records"])

    return archives.select("path").repartition(max(1, files), "path").mapInArrow(batches, "path string, index string, records long")


def read_archives(archives: DataFrame, folder: str, files: int) -> DataFrame:
    """All records of normalised archives, fetched member by member through the index.

    ``page_id, url, record_type, refers_to, payload binary (null for revisits), payload_bytes, payload_digest``.  The
    digest of a payload is computed from what was read and compared with the record's own.
    """
    names = ["page_id", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
    number = lambda text: int(text.removeprefix("<urn:page:").removesuffix(">") or -(2**63))

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names)

    def batches(stream):
        where, _ = _open(folder)
        for batch in stream:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist()):
                with where.open_input_stream(index, compression=None) as source:
                    places = [line.split(" ")[:2] for line in source.read().decode().splitlines()]
                rows, held = [], 0
                with where.open_input_file(path) as source:
                    for offset, size in places:
                        source.seek(int(offset))
                        headers, record = next(split_records(iter([zlib.decompress(source.read(int(size)), 31)])))
                        digest = headers["warc-payload-digest"].removeprefix("sha256:")
                        payload = None
                        if headers["warc-type"] == "response":
                            payload = record[record.index(b"\r\n\r\n") + 4 + len(HTTP) : -4]
                            if hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"damaged payload in {path} at {offset}")
                        page, refers = number(headers["warc-record-id"]), headers.get("warc-refers-to")
                        rows.append((None if page == -(2**63) else page, headers.get("warc-target-uri"), headers["warc-type"], number(refers) if refers else None, payload, int(headers["warc-payload-length"]), digest))
                        held += len(record)
                        if held > EMIT_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"
    return archives.select("path", "index").repartition(max(1, files), "path").mapInArrow(batches, schema)


def remove_files(archives: DataFrame, folder: str) -> None:
    """Delete the files that a table of archives names."""

    def each(rows):
        where, _ = _open(folder)
        for row in rows:
            where.delete_file(row["path"])

    archives.foreachPartition(each)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Pages to archives, to normalised archives, and back."""
    folder = shared_folder(pages.sparkSession, "warc")
    raw = staged(write_archives(record_types(pages), folder), "warc-raw")
    files = raw.count()
    clean = staged(normalise_archives(raw, folder, files), "warc-clean")
    remove_files(raw, folder)
    return read_archives(clean, folder, files)


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR p.page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first IS NULL OR p.page_id = first THEN NULL ELSE first END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


@query("op2_warc", ORACLE)
def op2_warc(spark, sf_dir):
    return archived_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
