"""WARC archives written and read as chunked record tables.

A payload travels as rows of (record, chunk number, bytes of one chunk), each
with the payload's length and SHA-1 so far, so that the last chunk's row holds
those of the whole and neither side ever joins a record's chunks in memory.
Archives are gzip files of one member a record; an oversized payload goes
through the compressor, and comes back out of the file, chunk by chunk. Each
task writes files of its own name and returns a row for each; only the rows of
tasks that succeeded make up the manifest, so what a lost executor began counts
for nothing.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, heavy_light, materialize, shared_uri, staged, text_buffers

#: Bytes of a chunk.
CHUNK = 1 << 18
#: Compressed bytes after which a task begins another file.
FILE_BYTES = 1 << 28
#: Payloads shorter than this are never written as revisits.
LEAST = 0
#: Bytes that a batch of chunk rows gathers before it goes on.
BATCH = 1 << 22
HEAD_LIMIT = 1 << 20

_CHUNKS = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("chunk", pa.int32()), ("data", pa.binary()), ("n_bytes", pa.int64()), ("digest", pa.string()), ("last", pa.bool_())])
CHUNK_TABLE = "record_id string, record_type string, target_uri string, refers_to string, chunk int, data binary, n_bytes long, digest string, last boolean"


def _base32(sha1) -> str:
    return base64.b32encode(sha1.digest()).decode()


def _gathered(rows: Iterator[tuple], schema: pa.Schema, size=lambda row: 200) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some MB."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += size(row)
        if n >= BATCH:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in held], schema)


def chunked(payload: memoryview, chunk: int) -> Iterator[tuple[int, memoryview, int, str, bool]]:
    """(chunk number, its bytes, payload bytes so far, digest so far, last) of one payload; an empty one is one empty chunk."""
    sha1, n = hashlib.sha1(), max(1, -(-len(payload) // chunk))
    for k in range(n):
        part = payload[k * chunk : (k + 1) * chunk]
        sha1.update(part)
        yield k, part, min((k + 1) * chunk, len(payload)), _base32(sha1), k == n - 1


def payload_facts(pages: DataFrame, key: str, payload_col: str = "html", chunk: int = CHUNK) -> DataFrame:
    """(key, n_bytes, digest): length and SHA-1 in base32 of each payload, from its chunks; null counts as empty."""
    schema = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.string())])

    def run(batches):
        for b in batches:
            buf, off = text_buffers(b.column("payload"))
            rows = ((k, n, digest) for k, i, j in zip(b.column("key").to_pylist(), off[:-1], off[1:], strict=True) for _, _, n, digest, last in chunked(memoryview(buf[i:j]), chunk) if last)
            yield from _gathered(rows, schema)

    return arrow_map(pages.select(F.col(key).cast("long").alias("key"), F.col(payload_col).cast("string").alias("payload")), run, "key long, n_bytes long, digest string")


def revisits(facts: DataFrame, least: int = LEAST) -> DataFrame:
    """facts with record_type and `first` (id and key of the response that a revisit repeats).

    facts: (key, id, n_bytes, digest), kept as it is read several times. Of
    equal payloads the one with the smallest id is the response; rows without
    id come last and rows of one id count by their key.
    """
    me = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("key"))
    groups = facts.groupBy("digest", "n_bytes").agg(F.min(me).alias("first"), F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n_bytes") >= least))
    met = heavy_light(facts, groups.drop("n_bytes"), "digest", "n", "left")
    again = F.coalesce(F.col("first.key") != F.col("key"), F.lit(False))
    return met.select("key", "id", "n_bytes", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("first"))


def _safe(value: str) -> str:
    """A header value on one line: other signs than printable ASCII become percent escapes."""
    return "".join(c if "\x20" < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def _head(row: dict, date: str) -> tuple[bytes, bytes]:
    """(record header, HTTP header) of a row."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", date)]
    fields += [("WARC-Target-URI", _safe(row["target_uri"]))] if row["target_uri"] is not None else []
    fields += [("WARC-Payload-Digest", f"sha1:{row['digest']}")]
    fields += [("WARC-Refers-To", f"<{row['refers_to']}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")] if revisit else []
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http) + (0 if revisit else row["n_bytes"])))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode(), http


def write_archives(records: DataFrame, path: str, chunk: int = CHUNK, file_bytes: int = FILE_BYTES, date: str | None = None) -> DataFrame:
    """Write records into archives under path and return the manifest (file, n_records, n_bytes), kept.

    records: record_id, record_type, target_uri, refers_to, n_bytes, digest and
    payload. `path` is a folder that all executors reach, as a path or URI.
    """
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    names = [f.name for f in _CHUNKS if f.name not in ("chunk", "data", "last")]

    def run(batches):
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(path) if "://" in path else FileSystem.from_uri(f"file://{path}")
        fs.create_dir(root, recursive=True)
        out, file, n, size = None, "", 0, 0

        def put(data: bytes) -> None:
            nonlocal size
            out.write(data)
            size += len(data)

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [file], "n_records": pa.array([n], pa.int64()), "n_bytes": pa.array([size], pa.int64())})

        for b in batches:
            buf, off = text_buffers(b.column("payload"))
            for k, row in enumerate(b.select(names).to_pylist()):
                if out is None:
                    file, n, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(file, compression=None)
                gz = zlib.compressobj(1, wbits=31)
                for part in _head(row, date):
                    put(gz.compress(part))
                if row["record_type"] != "revisit":
                    for _, part, *_ in chunked(memoryview(buf[off[k] : off[k + 1]]), chunk):
                        put(gz.compress(part))
                put(gz.compress(b"\r\n\r\n") + gz.flush())
                n += 1
                if size >= file_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return materialize(arrow_map(records.select(*names, "payload"), run, "file string, n_records long, n_bytes long"))


class _Stream:
    """Bytes of an archive, plain or gzip with any number of members, of which at most a few chunks are held."""

    def __init__(self, raw: BinaryIO, chunk: int):
        self.raw, self.chunk, self.held = raw, chunk, bytearray()
        start = raw.read(2)
        self.rest, self.gzip = start, start == b"\x1f\x8b"
        self.member = zlib.decompressobj(31) if self.gzip else None

    def more(self) -> bool:
        """Hold some more bytes; False at the end of the file."""
        while True:
            data = self.rest or self.raw.read(self.chunk)
            self.rest = b""
            if not data:
                if self.gzip and not self.member.eof:
                    raise ValueError("an archive ends inside a gzip member")
                return False
            if not self.gzip:
                self.held += data
                return True
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            out = self.member.decompress(data, self.chunk)
            self.rest = self.member.unused_data or self.member.unconsumed_tail
            if out:
                self.held += out
                return True

    def head(self) -> list[bytes] | None:
        """Lines up to the next blank one; None at the end of the file."""
        seen = 0
        while (at := self.held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.held)
            if seen > HEAD_LIMIT:
                raise ValueError("a header is longer than 1 MB")
            if not self.more():
                if self.held.strip():
                    raise ValueError("an archive ends inside a header")
                return None
        lines = bytes(self.held[:at]).split(b"\r\n")
        del self.held[: at + 4]
        return lines

    def block(self, n: int) -> Iterator[bytes]:
        """The next n bytes, a chunk at a time."""
        while n:
            if not self.held and not self.more():
                raise ValueError("an archive ends inside a record")
            part = bytes(self.held[: min(n, self.chunk)])
            del self.held[: len(part)]
            n -= len(part)
            yield part


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.decode("utf-8", "replace").partition(":") for line in lines[1:])}


def _even(parts: Iterator[bytes], chunk: int) -> Iterator[bytes]:
    """The same bytes in parts of exactly `chunk` (the last may be shorter, and is empty if there is nothing)."""
    held, any_yet = bytearray(), False
    for part in parts:
        held += part
        while len(held) > chunk:
            yield bytes(held[:chunk])
            any_yet = True
            del held[:chunk]
    if held or not any_yet:
        yield bytes(held)


def record_chunks(raw: BinaryIO, chunk: int = CHUNK) -> Iterator[tuple]:
    """Rows of the chunk table of one archive, in its order; revisits have one row without bytes, with the header's length and digest.

    A payload whose digest is not that of its header is an error.
    """
    stream = _Stream(raw, chunk)
    while (lines := stream.head()) is not None:
        f = _fields(lines)
        left = int(f["content-length"])
        kind, ids = f.get("warc-type"), [f[k].strip("<>") if k in f else None for k in ("warc-record-id", "warc-refers-to")]
        about = (ids[0], kind, f.get("warc-target-uri"), ids[1])
        said = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
        http = {}
        if f.get("content-type", "").startswith("application/http"):
            held = stream.head()
            if held is None:
                raise ValueError("an archive ends inside a record")
            left -= sum(len(x) + 2 for x in held) + 2
            http = _fields(held)
        if kind == "revisit":
            for _ in stream.block(left):
                pass
            yield (*about, 0, b"", int(http.get("content-length", 0)), said, True)
        else:
            sha1, n, total = hashlib.sha1(), 0, left
            for k, part in enumerate(_even(stream.block(left), chunk)):
                sha1.update(part)
                n += len(part)
                digest, last = _base32(sha1), n == total
                if last and said and http and digest != said:
                    raise ValueError(f"payload of {ids[0]} has digest {digest}, not {said}")
                yield (*about, k, part, n, digest, last)
        if b"".join(stream.block(4)) != b"\r\n\r\n":
            raise ValueError(f"record {ids[0]} is longer than its header says")


def read_archives(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunk table of the archives that the column `file` names (paths or URIs that executors reach), a task for each share of files."""

    def rows(file: str):
        from pyarrow.fs import FileSystem

        fs, place = FileSystem.from_uri(file if "://" in file else f"file://{file}")
        with fs.open_input_stream(place, compression=None) as raw:
            yield from record_chunks(raw, chunk)

    def run(batches):
        every = (row for b in batches for file in b.column("file").to_pylist() for row in rows(file))
        yield from _gathered(every, _CHUNKS, lambda row: 200 + len(row[5]))

    return arrow_map(manifest.select("file"), run, CHUNK_TABLE)


def archived(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = LEAST, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write each row of pages as a record and return the manifest of the archives.

    Record ids are `urn:page:<id>:<key>`; the key is the id where every row has
    one of its own, else a number given to each row in a written copy. A null
    payload is empty, a null url leaves its field out, other signs than
    printable ASCII in it become percent escapes. Rows that repeat an id are
    records of their own; an empty table gives an empty manifest; extra columns
    are ignored whatever their names. `path`: a folder of the shared one by
    default.
    """
    spark = pages.sparkSession
    path = path or f"{shared_uri(spark)}/archives-{uuid.uuid4().hex}"
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("target_uri"), F.col(payload_col).cast("string").alias("payload"))
    ids = rows.agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids")).first()
    if ids["rows"] == ids["ids"]:
        rows = rows.withColumn("key", F.col("id"))
        facts = payload_facts(rows, "key", "payload", chunk).withColumn("id", F.col("key"))
    else:
        rows = staged(rows.withColumn("key", F.monotonically_increasing_id()), "pages")
        facts = payload_facts(rows, "key", "payload", chunk).join(rows.select("key", "id"), "key")
    kinds = revisits(materialize(facts), least)
    name = lambda i, k: F.concat(F.lit("urn:page:"), F.coalesce(i.cast("string"), F.lit("")), F.lit(":"), k.cast("string"))
    kinds = kinds.select("key", name(F.col("id"), F.col("key")).alias("record_id"), "record_type", "n_bytes", "digest", F.when(F.col("first").isNotNull(), name(F.col("first.id"), F.col("first.key"))).alias("refers_to"))
    return write_archives(rows.drop("id").join(kinds, "key"), path, chunk, file_bytes)


def page_records(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each page record, from the last chunks read back."""
    page = lambda c: F.nullif(F.split(c, ":")[2], F.lit("")).cast("long")
    last = read_archives(manifest.repartition("file"), chunk).where("last")
    return last.select(page(F.col("record_id")).alias("page_id"), F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", page(F.col("refers_to")).alias("refers_to"))


def page_records_sql(least: int = LEAST) -> str:
    """The same from the table pages, for DuckDB (ids all different)."""
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT page_id, strlen(html) AS n,
      list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), 'string_agg', '') AS digest,
      min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first OR n < {least} THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first AND n >= {least} THEN first END AS refers_to FROM d"""
