"""WARC archives as a chunked record table.

Each task writes the records of its rows one after another to an archive of its own, streams payloads in chunks and
keeps a running digest, so no record is held in memory beyond the row that Spark hands over. Which pages repeat another
one's payload is known before anything is written, from digests and sizes alone: such a page becomes a revisit record,
which names the record that it refers to and has no payload of its own. Reading goes record by record along the index and
gives rows of record id and chunk number; type and reference come from the headers, and the last chunk of a record has
its digest.
"""
from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilnote.llm.common import TEXT_ROWS, new_path, written

#: Bytes of a chunk; bytes of archives that one task reads; payloads from this size on may be revisits.
CHUNK, READ_BYTES, LEAST = 64 << 10, 16 << 20, 100
#: Repeated payloads that are broadcast, at most; if more, pages are shuffled, equal ones over so many keys.
BROADCAST, KEYS = 200_000, 16

# Lines of a record as the WARC 1.1 format has them.
VERSION, LINE, AFTER = b"WARC/1.1", b"\r\n", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = "page_id long, chunk_no int, chunk binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _header(fields: list[tuple[str, str]]) -> bytes:
    return VERSION + LINE + b"".join(f"{k}: {v}".encode() + LINE for k, v in fields) + LINE


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>"


def with_firsts(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Adds `first` to pages(page_id, url, html): the page that the record revisits, null for a response. Of records with
    equal payloads of at least `least` bytes that with the smallest page_id is the response, and the others revisit it.
    Rows that repeat that page_id are responses as well; records without a page_id revisit too, or are responses if all
    equal ones have none."""
    alike = ["digest_", "bytes_"]
    payload = F.coalesce("html", F.lit(""))
    signed = pages.withColumns({"digest_": F.unhex(F.sha2(payload.cast("binary"), 256)), "bytes_": F.octet_length(payload).cast("long")})
    copies = written(signed.where(F.col("bytes_") >= least).groupBy(*alike).agg(
        F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1 and first is not null").drop("n"), "copies")
    if copies.count() <= BROADCAST:
        known = signed.join(F.broadcast(copies), alike, "left")
    else:
        key: Column = F.pmod(F.xxhash64("page_id", "url"), F.lit(KEYS)).cast("int")
        spread = copies.withColumn("key_", F.explode(F.sequence(F.lit(0), F.lit(KEYS - 1))))
        known = signed.withColumn("key_", key).join(spread, [*alike, "key_"], "left")
    return known.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """(page_id, path, start, size): the index of the archives written from pages(page_id, url, html) in the folder.

    The payload is the html in UTF-8, of a null html it is empty. A page that `with_firsts` finds to be a copy is a
    revisit record without the payload, with its size in X-Payload-Length; the others are responses. A task that is run again writes a new archive, and
    only archives in the index are read. The folder must be one that all executors share. It may be any that pyarrow
    reaches: a path, or a URI of HDFS or an object store.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pa.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pa.fs.LocalFileSystem(), folder)
        files.create_dir(root, recursive=True)
        path, at, out = f"{root}/{uuid.uuid4().hex}.warc", 0, None
        try:
            for batch in batches:
                index: list[tuple[int | None, str, int, int]] = []
                for page, url, html, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                    out = out or files.open_output_stream(path)
                    payload = html.as_buffer() if html.is_valid else pa.py_buffer(b"")
                    digest = hashlib.sha256()
                    for lo in range(0, payload.size, CHUNK):
                        digest.update(payload.slice(lo, min(CHUNK, payload.size - lo)))
                    named = [] if url is None else [("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A"))]
                    kind, refers, total = "response", [], payload.size
                    if first is not None:
                        kind, payload = "revisit", pa.py_buffer(b"")
                        refers = [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(first, digest.hexdigest())),
                                  ("X-Refers-To-Page-ID", str(first)), ("X-Payload-Length", str(total))]
                    head = _header([("WARC-Type", kind), ("WARC-Record-ID", _record_id(page, digest.hexdigest())),
                                    ("X-Page-ID", "" if page is None else str(page)), ("WARC-Date", "1970-01-01T00:00:00Z"), *named, *refers,
                                    ("WARC-Payload-Digest", f"sha256:{digest.hexdigest()}"), ("Content-Length", str(payload.size))])
                    out.write(head)
                    for lo in range(0, payload.size, CHUNK):
                        out.write(payload.slice(lo, min(CHUNK, payload.size - lo)))
                    out.write(AFTER)
                    size = len(head) + payload.size + len(AFTER)
                    index.append((page, path, at, size))
                    at += size
                if index:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*index, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["page_id", "path", "start", "size"])
        finally:
            if out:
                out.close()

    # The index is written at once: it names the archives of the attempts that succeeded.
    ready = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return written(with_firsts(ready).mapInArrow(write, "page_id long, path string, start long, size long"), "index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """CHUNKS of the records of an index, payload by payload; an empty payload has one empty chunk. payload_bytes is the
    size so far, payload_digest the bare SHA-256 in hex on the last chunk and null before it. A revisit has one empty chunk,
    with size and digest of the payload that it refers to, as its header has them; refers_to is that record's page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = pa.fs.FileSystem.from_uri(folder)[0] if "://" in folder or folder.startswith("file:") else pa.fs.LocalFileSystem()
        path, source = None, None
        rows: list[tuple[int | None, int, bytes, int, str | None, str, int | None]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                              ["page_id", "chunk_no", "chunk", "payload_bytes", "payload_digest", "record_type", "refers_to"])

        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != path:
                    path, source = name, files.open_input_file(name)
                source.seek(start)
                head = b""
                while AFTER not in head:
                    more = source.read(1024)
                    if not more:
                        raise ValueError(f"{name}: no whole record at {start}")
                    head += more
                lines, _, rest = head.partition(AFTER)
                if not lines.startswith(VERSION):
                    raise ValueError(f"{name}: no record starts at {start}")
                fields = dict(line.split(b": ", 1) if b": " in line else (line.rstrip(b":"), b"") for line in lines.split(LINE)[1:])
                page = int(fields[b"X-Page-ID"]) if fields[b"X-Page-ID"] else None
                kind, told = fields[b"WARC-Type"].decode(), fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
                if kind == "revisit":
                    rows.append((page, 0, b"", int(fields[b"X-Payload-Length"]), told, kind, int(fields[b"X-Refers-To-Page-ID"])))
                    if len(rows) >= TEXT_ROWS:
                        yield flush()
                        rows, held = [], 0
                    continue
                left, number, done, digest = int(fields[b"Content-Length"]), 0, 0, hashlib.sha256()
                while True:
                    chunk, rest = rest[:min(left, CHUNK)], rest[min(left, CHUNK):]
                    if len(chunk) < min(left, CHUNK):
                        chunk += source.read(min(left, CHUNK) - len(chunk))
                    if not chunk and left:
                        raise ValueError(f"{name}: the record at {start} is cut off")
                    digest.update(chunk)
                    left, done, held = left - len(chunk), done + len(chunk), held + len(chunk)
                    if not left and digest.hexdigest() != told:
                        raise ValueError(f"{name}: the payload at {start} isn't that of its digest")
                    rows.append((page, number, chunk, done, None if left else told, kind, None))
                    number += 1
                    if held > 32 * CHUNK or len(rows) >= TEXT_ROWS:
                        yield flush()
                        rows, held = [], 0
                    if not left:
                        break
        if rows:
            yield flush()

    total = index.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    part = F.concat_ws(" ", "path", F.floor(F.col("start") / READ_BYTES))
    ranges = index.select("path", "start").repartition(total // READ_BYTES + 1, part).sortWithinPartitions("path", "start")
    return ranges.mapInArrow(read, CHUNKS)


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each row of pages(page_id, url, html), from
    archives that are written to the shared folder and read back. Null and empty html have empty payloads; null and
    repeated ids are records like any other; extra columns are ignored."""
    folder = new_path(spark, "warc")
    chunks = read_archives(write_archives(pages, folder), folder)
    return written(chunks.where("payload_digest is not null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "records")


#: Comparison: what the records must be, straight from the pages.
SQL = """
WITH records AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM records WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id <> first THEN first END AS refers_to
FROM records LEFT JOIN firsts USING (payload_digest)
"""
