"""Write web archives and read them back, salvaging what damage left.

Pages become records of gzipped WARC/1.1 files, one gzip member to a record. Of
pages with equal payloads the one with the largest id is the response, the
others are revisits without a body. Tasks write under a name of their own and
move the finished file to one that depends on the partition only, so a task
that runs again replaces its file.

The reader walks a file member by member. If a member, a record or a payload
digest fails its check, it searches for the next gzip header, or the next
version line in files that are not compressed, at which a whole record starts,
goes on from there, and returns the bytes in between as a gap. It keeps a
window of the file in memory that grows to the size of one record.

Defined cases: a null html is an empty payload; a null url or page_id is left
out of the record and read back as null; if all pages of a payload have a null
id, all are responses; pages that repeat id and payload are equal records; an
empty table writes empty archives and reads no rows; further columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common

MIN_BYTES = 0
CHUNK = 1 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"
VERSION = b"WARC/1.1\r\n"
GZIP = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, records long, bytes long"
RECORD = (
    "file string, place long, size long, kind string, page_id long, url string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; a revisit if ``refers_to`` is not None."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if revisit:
        head += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("Refers-To-Page-ID", str(refers_to)),
        ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return VERSION + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _compressed(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write(folder: str):
    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}.warc.gz"
        own = f"{root}/.{name}-{context.taskAttemptId()}"
        records = size = 0
        with store.open_output_stream(own, compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    payload = (row["html"] or "").encode()
                    digest = base32(bytes.fromhex(row["sha1"]))
                    data = _compressed(
                        record(row["page_id"], row["url"], payload, digest, row["refers_to"])
                    )
                    out.write(data)
                    records += 1
                    size += len(data)
        store.move(own, f"{root}/{name}")
        yield pa.RecordBatch.from_pydict(
            {"file": [name], "records": [records], "bytes": [size]},
            pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return write


def write_archives(
    spark: SparkSession, pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES
) -> DataFrame:
    """Write one archive per partition below ``folder``; returns their manifest."""
    session.ship_package(spark)
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html).alias("sha1"),
    )
    shared = F.octet_length("html") >= min_bytes
    keepers = rows.where(shared).groupBy("sha1").agg(F.max("page_id").alias("keeper"))
    other = shared & (F.col("page_id") != F.col("keeper"))
    # a page without an id cannot be the one that others refer to
    other = F.coalesce(other, shared & F.col("page_id").isNull() & F.col("keeper").isNotNull())
    linked = rows.join(keepers, "sha1", "left").select(
        "page_id", "url", "html", "sha1", F.when(other, F.col("keeper")).alias("refers_to")
    )
    return common.written(spark, linked.mapInArrow(_write(folder), MANIFEST), "manifest")


class Window:
    """Part of a file, from ``start`` on, that grows as it is asked for more."""

    def __init__(self, stream):
        self.stream, self.start, self.data, self.ended = stream, 0, bytearray(), False

    def more(self) -> bool:
        got = b"" if self.ended else self.stream.read(CHUNK)
        self.ended = not got
        self.data += got
        return not self.ended

    def drop(self, n: int) -> None:
        del self.data[:n]
        self.start += n


class Damaged(ValueError):
    pass


def _member(window: Window) -> tuple[bytes, int]:
    """The gzip member at the window's start, checked, and its size in the file."""
    unpack, out, at = zlib.decompressobj(31), [], 0
    while not unpack.eof:
        if at == len(window.data) and not window.more():
            raise Damaged("the member is cut short")
        piece = bytes(window.data[at : at + CHUNK])
        try:
            out.append(unpack.decompress(piece))
        except zlib.error as error:
            raise Damaged(str(error)) from error
        at += len(piece)
    return b"".join(out), at - len(unpack.unused_data)


def _plain(window: Window) -> tuple[bytes, int]:
    """The uncompressed record at the window's start."""
    while (end := window.data.find(b"\r\n\r\n")) < 0:
        if len(window.data) > CHUNK or not window.more():
            raise Damaged("no end of the header")
    length = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r$", window.data[: end + 2])
    if not window.data.startswith(b"WARC/") or length is None:
        raise Damaged("no record")
    size = end + 4 + int(length[1]) + 4
    while len(window.data) < size:
        if not window.more():
            raise Damaged("the record is cut short")
    return bytes(window.data[:size]), size


def parse(data: bytes) -> dict:
    """The fields of one whole record; Damaged if a check fails."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not re.fullmatch(rb"WARC/\d\.\d", lines[0]):
        raise Damaged("no version line")
    try:
        fields = dict(line.decode().split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        block, end = rest[:size], rest[size:]
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
        http, _, payload = block.partition(b"\r\n\r\n")
        full = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    except (KeyError, ValueError, TypeError) as error:
        raise Damaged(f"unreadable header: {error!r}") from error
    if len(block) != size or end != b"\r\n\r\n":
        raise Damaged("wrong length")
    if fields.get("WARC-Block-Digest") != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise Damaged("wrong block digest")
    if kind == "response" and base32(hashlib.sha1(payload).digest()) != digest:
        raise Damaged("wrong payload digest")

    def number(name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    return {
        "kind": kind,
        "page_id": number("Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": full,
        "payload_digest": digest,
        "refers_to": number("Refers-To-Page-ID"),
        "payload": payload if kind == "response" else None,
    }


def salvage(stream, name: str) -> Iterator[dict]:
    """Records and gaps of one archive, in order; together they cover the whole file."""
    window, gap = Window(stream), None

    def gap_row(end: int) -> dict:
        return {"file": name, "place": gap, "size": end - gap, "kind": "gap"}

    while window.data or window.more():
        if len(window.data) < 16:
            window.more()
        zipped = window.data.startswith(GZIP)
        try:
            data, size = _member(window) if zipped else _plain(window)
            fields = parse(data)
        except Damaged:
            if gap is None:
                gap = window.start
            _seek(window)
            continue
        if gap is not None:
            yield gap_row(window.start)
            gap = None
        yield {"file": name, "place": window.start, "size": size} | fields
        window.drop(size)
    if gap is not None:
        yield gap_row(window.start)


def _seek(window: Window) -> None:
    """Move to the next place after the start where a member or a version line may begin."""
    at = 1
    while True:
        places = [p for mark in (GZIP, b"WARC/1.") if (p := window.data.find(mark, at)) >= 0]
        if places:
            window.drop(min(places))
            return
        # a mark may lie across the end of what has been read
        window.drop(max(len(window.data) - 6, 0))
        at = 0
        if not window.more():
            window.drop(len(window.data))
            return


def _read(with_payload: bool):
    schema = pa.schema(
        [
            ("file", pa.string()), ("place", pa.int64()), ("size", pa.int64()),
            ("kind", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("refers_to", pa.int64()), ("payload", pa.binary()),
        ]
    )

    def rows_of(path: str) -> Iterator[dict]:
        store, place = fs.FileSystem.from_uri(path)
        with store.open_input_stream(place, compression=None) as stream:
            yield from salvage(stream, path)

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, held = [], 0
                for row in rows_of(path):
                    if not with_payload:
                        row["payload"] = None
                    held += len(row.get("payload") or b"")
                    rows.append(row)
                    if len(rows) >= 5000 or held > 8 * CHUNK:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return read


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records and gaps of the archives below ``folder``."""
    session.ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").load(folder)
    return files.select("path").mapInArrow(_read(with_payload), RECORD)
