"""WARC archives with a two-level capture index.

Archives hold one gzip member per record, so any record can be read by its byte
range. Of payloads that several pages share and that are long enough, one
record is the response and the others revisit it without the payload.

The index has the captures' keys -- host labels in reverse order, path, page
number -- sorted over all pages, in compressed blocks. Each index file ends
with a sparse directory: the first key of every block and where the block lies.
A lookup finds the index file by the files' first keys, the block by binary
search in that directory, and reads only that block, then only the record's
byte range.

All files lie in the shared store under names of their own; the tables that the
writing tasks return name those that count, so a task that runs again leaves
nothing behind that is ever read.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_keys, join_unique
from ..session import release
from .common import borrowed, partitions, shared_path, small_batches, written
from .worker import Folder

#: Shortest payload that is revisited; bytes of an archive file before the next begins; lines of an index block.
LEAST_PAYLOAD, ARCHIVE_BYTES, BLOCK_LINES = 1000, 64 << 20, 512
#: Bytes of archives that a task reads back at least, and most reading tasks for each partition of a shuffle.
READ_BYTES, MOST_TASKS = 8 << 20, 16
READ_AHEAD = 1 << 20
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"


def clean_url(url: str | None) -> str:
    """The URL with blanks and control characters percent-encoded; empty for null."""
    return re.sub(r"[\x00-\x20\x7f\u0085  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "")


def capture_key(url: str | None, page_id: int | None) -> str:
    """Sort key of a capture: reversed host, path and query, page number."""
    url = clean_url(url)
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split("."))) if parts.hostname else ""
        rest = parts.path + (f"?{parts.query}" if parts.query else "")
    except ValueError:  # not a URL
        host, rest = "", ""
    place = f"{host}){rest or '/'}" if host else f"-){url}"
    return f"{place} {'-' if page_id is None else f'{page_id + (1 << 63):020d}'}"


def record(kind: str, page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record, not compressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if kind == "response":
        http += b"Content-Length: %d\r\n" % len(payload)
    block = http + CRLF + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", clean_url(url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return b"WARC/1.1\r\n" + lines + CRLF + block + CRLF + CRLF


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = raw.partition(CRLF + CRLF)
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[:int(fields["Content-Length"])]
    return fields, block.partition(CRLF + CRLF)[2]


def page_of(uri: str) -> int | None:
    number = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def gzipped(raw: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes every row of ``pages`` as a record (null html: empty payload) and
    returns the captures: ``key``, ``file``, ``offset``, ``length``.

    Among records of equal payloads of at least LEAST_PAYLOAD bytes those with
    the largest page id are responses (of repeated rows each one), the others
    revisits; if all ids are null, all are responses. ``pages`` should be a scan
    or a written table, so that a task that runs again numbers its rows the same
    way.
    """
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.length("payload")})
    rows = rows.withColumn("same", F.when(F.col("size") >= LEAST_PAYLOAD, F.concat_ws("-", "digest", "size"))
                           .otherwise(F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))))
    first = (rows.filter(F.col("size") >= LEAST_PAYLOAD).groupBy("same")
             .agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1"))
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    # a payload that a third of all pages share goes to many tasks
    marked = join_unique(rows, first.drop("n"), "same", "left", hot_keys(first, "same", "n")).select("id", "url", "payload", "digest", refers.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, out, name, at = Folder(folder), None, "", 0
        for batch in batches:
            keys, files, offsets, lengths = [], [], [], []
            for i, u, body, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None or at >= ARCHIVE_BYTES:
                    if out:
                        out.close()
                    name, out = store.new_file(".warc.gz")
                    about = b"software: tallgrass\r\nformat: WARC File Format 1.1\r\n"
                    info = gzipped(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-file:" + name.encode()
                                   + b">\r\nWARC-Date: " + DATE.encode() + b"\r\nContent-Type: application/warc-fields\r\n"
                                   b"Content-Length: %d\r\n\r\n%s\r\n\r\n" % (len(about), about))
                    out.write(info)
                    at = len(info)
                raw = gzipped(record("response" if refers_to is None else "revisit", i, u, digest, body, refers_to))
                out.write(raw)
                keys.append(capture_key(u, i))
                files.append(name)
                offsets.append(at)
                lengths.append(len(raw))
                at += len(raw)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()),
                                              pa.array(lengths, pa.int64())], names=["key", "file", "offset", "length"])
        if out:
            out.close()

    return written(marked.mapInArrow(run, "key string, file string, offset long, length long"), "captures")


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[str, str]]:
    """Sorts the captures' keys over all index files and writes these; returns
    the first key and the name of each, in order (one entry per file)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = Folder(folder)
        name, out, at, lines, directory = "", None, 0, [], []

        def close_block() -> None:
            nonlocal at, lines
            raw = zlib.compress("\n".join(lines).encode())
            directory.append([lines[0].rpartition("\t")[0], at, len(raw)])
            out.write(raw)
            at, lines = at + len(raw), []

        for batch in batches:
            for key, *where in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name, out = store.new_file(".cdx")
                lines.append(f"{key}\t{json.dumps(where)}")
                if len(lines) == block_lines:
                    close_block()
        if out:
            if lines:
                close_block()
            raw = zlib.compress(json.dumps(directory).encode())
            out.write(raw + len(raw).to_bytes(8, "little"))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([name])], names=["first", "file"])

    ordered = captures.select("key", "file", "offset", "length").repartitionByRange("key", "file", "offset") \
        .sortWithinPartitions("key", "file", "offset")
    files = written(ordered.mapInArrow(run, "first string, file string"), "index-files")
    found = sorted((r["first"], r["file"]) for r in files.collect())
    release(files)
    return found


class Index:
    """Lookups in the index files, which are given with their first keys."""

    def __init__(self, store: Folder, files: list[tuple[str, str]]):
        self.store, self.files, self.firsts = store, files, [f for f, _ in files]
        self.opened: str = ""
        self.block_at: tuple[str, int] | None = None

    def _open(self, name: str) -> None:
        if self.opened != name:
            self.opened, self.file = name, self.store.open(name)
            size = self.file.size()
            self.file.seek(size - 8)
            n = int.from_bytes(self.file.read(8), "little")
            self.file.seek(size - 8 - n)
            self.directory = json.loads(zlib.decompress(self.file.read(n)))
            self.starts = [d[0] for d in self.directory]

    def _block(self, k: int) -> None:
        if self.block_at != (self.opened, k):
            self.block_at = (self.opened, k)
            _, at, n = self.directory[k]
            self.file.seek(at)
            self.lines = zlib.decompress(self.file.read(n)).decode().split("\n")
            self.keys = [x.rpartition("\t")[0] for x in self.lines]

    def lookup(self, key: str) -> Iterator[tuple[str, int, int]]:
        """File, offset and length of every capture with the key."""
        # equal keys may begin in the block or file before the first one that starts with the key
        for _, name in self.files[max(0, bisect.bisect_left(self.firsts, key) - 1):bisect.bisect_right(self.firsts, key)]:
            self._open(name)
            for k in range(max(0, bisect.bisect_left(self.starts, key) - 1), bisect.bisect_right(self.starts, key)):
                self._block(k)
                for line in self.lines[bisect.bisect_left(self.keys, key):bisect.bisect_right(self.keys, key)]:
                    yield tuple(json.loads(line.rpartition("\t")[2]))


def locate(requests: DataFrame, folder: str, files: list[tuple[str, str]], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``file``, ``offset`` and ``length`` of every capture of the requested
    pages; a page requested several times is looked up once."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [capture_key(u, i) for i, u in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, last = Index(Folder(folder), files), None
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                if key != last:
                    rows += index.lookup(key)
                last = key
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
                                              pa.array(columns[2], pa.int64())], names=["file", "offset", "length"])

    wanted = requests.select(F.col(page_id).cast("long"), F.col(url)).mapInArrow(keys, "key string").distinct()
    ordered = wanted.repartitionByRange(partitions(requests.sparkSession), "key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "file string, offset long, length long")


def read_records(places: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """The records at some places of the archives: ``page_id``, ``url``,
    ``record_type``, ``payload`` (null for revisits), ``payload_digest`` (of
    responses computed from the payload, of revisits as their header has it)
    and ``refers_to``. Places are read in order by ``tasks`` tasks, by default
    as many as a shuffle has: their own size says nothing of what they point to."""
    small_batches(places.sparkSession)
    tasks = tasks or partitions(places.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, opened, file, begin, held = Folder(folder), "", None, 0, b""
        names = ["page_id", "url", "record_type", "payload", "payload_digest", "refers_to"]
        types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64()]
        for batch in batches:
            rows, size = [], 0
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name != opened:
                    opened, file, begin, held = name, store.open(name), 0, b""
                if not begin <= offset <= offset + length <= begin + len(held):
                    file.seek(offset)
                    begin, held = offset, file.read(max(length, READ_AHEAD))
                raw = zlib.decompress(held[offset - begin:offset - begin + length], 31)
                fields, payload = parse_record(raw)
                kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"{name}: the payload at {offset} is not the one that was written")
                rows.append((page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind,
                             payload if kind == "response" else None, digest,
                             page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None))
                size += len(payload)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    ordered = places.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, "page_id long, url string, record_type string, payload binary, payload_digest string, refers_to long")


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes all pages, looks every one up in the index, reads its record back
    and returns ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type`` and ``refers_to``. A revisit has the length of the payload
    of the response that it refers to."""
    folder = shared_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, page_id, url, html)
    files = write_index(captures, folder)
    size = captures.agg(F.sum("length")).first()[0] or 0
    release(captures)
    tasks = max(1, min(-(-size // READ_BYTES), MOST_TASKS * partitions(pages.sparkSession)))
    places = written(locate(pages, folder, files, page_id, url), "places")
    records = written(read_records(places, folder, tasks).select(
        "page_id", F.length("payload").cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"), "records")
    release(places)
    source = F.concat_ws("-", F.coalesce("refers_to", "page_id").cast("string"), "payload_digest")
    known = records.withColumn("source", source)
    there = known.filter("record_type = 'response'").groupBy("source").agg(F.max("payload_bytes").alias("whole"))
    again = join_unique(known.filter("record_type = 'revisit'"), there, "source", "left").select(
        "page_id", F.col("whole").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    return borrowed(records.filter("record_type = 'response'").unionByName(again), records, folder=folder)
