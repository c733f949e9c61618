"""WARC archives with a two-level capture index.

Pages are written as gzip members of WARC records, one archive per task; payloads that occur again are revisits
of one response. The captures, sorted by reversed-host key, are cut into compressed blocks; per shard a sparse
directory holds each block's first and last key and its place. A lookup searches the shards' bounds, then the
shard's directory, both by bisection, reads the one block by its byte range, and from it the records' ranges.

Files are written under names that no other attempt uses, and only those named in committed tables count, so a
lost executor leaves at most an unused file.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kwarta.llm.shared import new_folder, place, qualified, small_batches, written

#: Payloads below this many bytes are always written.
LEAST_SHARED = 1_000
#: Captures of a block, bytes after which an archive is closed, and bytes read at once.
BLOCK_LINES, ARCHIVE_BYTES, READ_BYTES = 1_000, 256 << 20, 4 << 20
#: Compression level of the records.
LEVEL = 5
DATE = "2024-01-01T00:00:00Z"

_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_GZIP = 31  # zlib's window for gzip members


def reversed_host(url: str | None) -> str:
    """Key that sorts a site's pages together: host parts in reverse, then the rest; "-" without a url."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", key)


def record(page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record; with refers_to a revisit without payload."""
    revisit = refers_to is not None
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = head + (b"\r\n" if revisit else b"Content-Length: %d\r\n\r\n" % len(payload) + payload)
    target = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {target}"] if target else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        *(["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
           f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """A record's fields; the payload is what follows the HTTP head."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    number = lambda name: int(n) if (n := fields.get(name, "").removeprefix("<urn:page:").rstrip(">")) else None
    return {
        "page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "digest": base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex(),
        "refers_to": number("WARC-Refers-To"), "payload": block.partition(b"\r\n\r\n")[2],
    }


def _writer(folder: str):
    """Rows of pages become an archive; back come the captures."""
    names = ["key", "page_id", "path", "start", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        out, path, at = None, None, 0
        try:
            for batch in batches:
                found = []
                for page_id, url, digest, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        path, at = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(path, compression=None)
                    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
                    member = squeeze.compress(record(page_id, url, digest, payload, refers_to)) + squeeze.flush()
                    out.write(member)
                    found.append((reversed_host(url), page_id, path.rpartition("/")[2], at, len(member)))
                    at += len(member)
                columns = list(zip(*found, strict=True)) or [()] * 5
                kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(
    pages: DataFrame, folder: str, payload: str = "html", url: str = "url", page_id: str = "page_id", *, least: int = LEAST_SHARED,
) -> DataFrame:
    """One record per row in archives below the folder; back comes the table of captures.

    The payload is the text in UTF-8, null as empty. Of equal payloads of at least `least` bytes the row with
    the largest page_id is the response, the others revisit it; repeated rows of that id are all responses. A
    null page_id is below all others; where no id is known all are responses. Empty table: no archive.
    """
    small_batches(pages.sparkSession)
    folder = qualified(pages.sparkSession, folder)
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    rows = pages.select(
        pages[f"`{page_id}`"].cast("long").alias("id"), pages[f"`{url}`"].cast("string").alias("url"),
        F.encode(F.coalesce(pages[f"`{payload}`"].cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = (
        rows.where(F.octet_length("payload") >= least).groupBy("digest")
        .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select("digest", "first"))
    told = rows.join(shared, "digest", "left")
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    sent = told.select("id", "url", "digest", F.when(refers.isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"), refers.alias("refers_to"))
    captures, _ = written(sent.mapInArrow(_writer(folder), "key string, page_id long, path string, start long, bytes long"), "warc-captures")
    return captures


class Index:
    """Where an index lies: its folder and the shards' bounds (a row per task that wrote it)."""

    def __init__(self, folder: str, archives: str, shards: list[tuple[str, str, str]]) -> None:
        self.folder, self.archives = folder, archives
        ordered = sorted(shards)
        self.first, self.last = [s[0] for s in ordered], [s[1] for s in ordered]
        self.name = [s[2] for s in ordered]


def build_index(captures: DataFrame, archives: str, folder: str, *, lines: int = BLOCK_LINES) -> Index:
    """Sort captures by key into shards of compressed blocks, each with its directory.

    Key and page_id deal them out, so a key with many captures spreads over blocks and shards.
    """
    archives, folder = qualified(captures.sparkSession, archives), qualified(captures.sparkSession, folder)
    system, root = place(folder)
    system.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(folder)
        name, at, directory, waiting, out = uuid.uuid4().hex, 0, [], [], None

        def close_block() -> None:
            nonlocal at, out
            if out is None:
                out = system.open_output_stream(f"{root}/{name}.cdx.gz", compression=None)
            squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
            data = squeeze.compress("\n".join(json.dumps(x) for x in waiting).encode()) + squeeze.flush()
            out.write(data)
            directory.append((waiting[0][0], waiting[-1][0], at, len(data)))
            at += len(data)
            waiting.clear()

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append(row)
                if len(waiting) >= lines:
                    close_block()
        if waiting:
            close_block()
        if out is not None:
            out.close()
            with system.open_output_stream(f"{root}/{name}.directory.gz", compression=None) as file:
                file.write(zlib.compress(json.dumps(directory).encode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([directory[0][0]]), pa.array([max(d[1] for d in directory)]), pa.array([name])], names=["first", "last", "name"])

    sorted_captures = captures.select("key", "page_id", "path", "start", "bytes").repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "path", "start")
    shards, _ = written(sorted_captures.mapInArrow(run, "first string, last string, name string"), "warc-shards")
    return Index(folder, archives, [tuple(r) for r in shards.collect()])


@lru_cache(64)
def _directory(folder: str, name: str) -> tuple[list[str], list[str], list[tuple[int, int]]]:
    """A shard's directory: its blocks' first keys, last keys and places."""
    system, root = place(folder)
    with system.open_input_file(f"{root}/{name}.directory.gz") as file:
        rows = json.loads(zlib.decompress(file.read()))
    return [r[0] for r in rows], [r[1] for r in rows], [(r[2], r[3]) for r in rows]


@lru_cache(8)
def _block(folder: str, name: str, start: int, size: int) -> tuple[list[str], list[list]]:
    """A block's keys and captures, read by its byte range."""
    system, root = place(folder)
    with system.open_input_file(f"{root}/{name}.cdx.gz") as file:
        data = zlib.decompress(file.read_at(size, start), _GZIP)
    rows = [json.loads(line) for line in data.decode().split("\n")]
    return [r[0] for r in rows], rows


def blocks_of(index: Index, key: str) -> Iterator[tuple[str, int, int]]:
    """The blocks that can hold a key, as shard and byte range: bisect the shards' bounds, then their directories."""
    for shard in range(bisect_left(index.last, key), bisect_right(index.first, key)):
        first, last, places = _directory(index.folder, index.name[shard])
        for b in range(bisect_left(last, key), bisect_right(first, key)):
            yield index.name[shard], *places[b]


def captures_in(index: Index, key: str, name: str, start: int, size: int) -> list[list]:
    """A key's captures in a block."""
    keys, rows = _block(index.folder, name, start, size)
    return rows[bisect_left(keys, key) : bisect_right(keys, key)]


def lookup(spark: SparkSession, index: Index, urls: DataFrame, url: str = "url") -> DataFrame:
    """Captures of every distinct url (null too): key, page_id, path, start, bytes. Unknown urls give no row.

    Directories tell which blocks can hold a key. The pairs are then dealt by block, so the blocks of a key with many
    captures are read by many tasks, and each block by one.
    """
    sent = spark.sparkContext.broadcast(index)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([reversed_host(u) for u in batch.column(0).to_pylist()], pa.string())], names=["key"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key in batch.column(0).to_pylist():
                rows += [(key, *block) for block in blocks_of(sent.value, key)]
            if rows:
                columns = zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names=["key", "name", "start", "size"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())

        def batch_of(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "page_id", "path", "start", "bytes"])

        for batch in batches:
            rows = []
            for wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += captures_in(sent.value, *wanted)
                if len(rows) >= BLOCK_LINES:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    distinct, _ = written(urls.select(urls[f"`{url}`"].cast("string").alias("url")).mapInArrow(keys, "key string").distinct(), "warc-keys")
    wanted = distinct.repartition("key").mapInArrow(blocks, "key string, name string, start long, size long")
    dealt = wanted.repartition("name", "start").sortWithinPartitions("name", "start", "key")
    return dealt.mapInArrow(find, "key string, page_id long, path string, start long, bytes long")


def read(captures: DataFrame, archives: str) -> DataFrame:
    """The records of captures: page_id, url, record_type, digest, refers_to, payload (empty for revisits).

    Captures are dealt by archive and sorted by place; neighbouring ranges are read together.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = place(archives)
        name, file = None, None
        kinds = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}

        def records(group: list[tuple[int, int]]) -> pa.RecordBatch:
            first = group[0][0]
            data = file.read_at(group[-1][0] + group[-1][1] - first, first)
            found = [parse(zlib.decompress(data[s - first : s - first + n], _GZIP)) for s, n in group]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in kinds.items()], names=list(kinds))

        try:
            for batch in batches:
                group: list[tuple[int, int]] = []
                for path, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if group and (path != name or start + size - group[0][0] > READ_BYTES):
                        yield records(group)
                        group = []
                    if path != name:
                        if file is not None:
                            file.close()
                        name, file = path, system.open_input_file(f"{root}/{path}")
                    group.append((start, size))
                if group:
                    yield records(group)
        finally:
            if file is not None:
                file.close()

    dealt = captures.select("path", "start", "bytes").repartition("path").sortWithinPartitions("path", "start")
    return dealt.mapInArrow(run, "page_id long, url string, record_type string, digest string, refers_to long, payload binary")


def round_trip(pages: DataFrame, payload: str = "html", url: str = "url", page_id: str = "page_id") -> DataFrame:
    """Write every page, look every url up in the index, and read the records back.

    Per record: page_id, payload_bytes and payload_digest (lower-case hex SHA-1) of the full payload,
    record_type, refers_to; payload_bytes of a revisit are those of the response it names, which has the same
    digest: ids may repeat with other payloads. A null page_id, url or payload is a page like others (the payload
    empty). Repeated rows give repeated records. Empty table: no rows. Columns that are not named are not read.
    """
    spark = pages.sparkSession
    archives = new_folder(spark, "warc")
    captures = write_archives(pages, archives, payload, url, page_id)
    index = build_index(captures, archives, new_folder(spark, "warc-index"))
    records, _ = written(
        read(lookup(spark, index, pages, url), archives).select(
            "page_id", "record_type", "refers_to", F.octet_length("payload").cast("long").alias("size"),
            F.when(F.col("record_type") == "response", F.sha1("payload")).otherwise(F.col("digest")).alias("payload_digest")),
        "warc-records")
    sizes = records.where("record_type = 'response'").select(
        F.col("page_id").alias("response"), F.col("payload_digest").alias("digest"), F.col("size").alias("full")).distinct()
    same = (F.col("refers_to") == F.col("response")) & (F.col("payload_digest") == F.col("digest"))
    again = records.where("record_type = 'revisit'").join(sizes, same, "left").withColumn("size", F.col("full"))
    names = ["page_id", F.col("size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"]
    return records.where("record_type = 'response'").select(*names).unionByName(again.select(*names))
