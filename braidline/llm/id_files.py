"""Token ids of documents in checksummed, entropy-coded files.

Documents are dealt to ranges of doc_id, sorted, tokenized, and written as one
file per range. A file is a sequence of sections of at most SECTION ids:

    magic "BIDF", version, number of document entries, number of blocks
    entries: doc_id, ids in this section, flags (1: goes on in the next section,
        2: the doc_id is null)
    blocks: number of ids, number of 16-bit words, CRC-32 of the ids
    CRC-32 of all the above
    the words of all blocks

All numbers are little-endian. Blocks hold BLOCK ids, start from the same coder
state each, and are decoded without any other. A block whose ids do not match
their checksum, or a header that does not match its own, fails the reader with
the file's name. A task that runs again replaces its file.

Defined cases: a null or empty text is its end id alone; null doc_ids come
first; rows that share a doc_id follow by the hash of their text, each with its
own entry; an empty table writes files without sections and reads no rows;
further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common, id_coder, tokens

MAGIC = b"BIDF"
VERSION = 2
BLOCK = 4096
BLOCKS = 1536
SECTION = BLOCK * BLOCKS
END_ID = 2
GOES_ON, NO_ID = 1, 2

HEAD = struct.Struct("<4sIII")
ENTRY = np.dtype([("doc_id", "<i8"), ("ids", "<u4"), ("flags", "<u4")])
INDEX = np.dtype([("ids", "<u4"), ("words", "<u4"), ("crc", "<u4")])

MANIFEST = "file string, docs long, ids long"
DECODED = "file string, place long, doc_id long, n_tokens long, ids_crc32 long, ids binary"


def pack_section(entries: list[tuple], ids: np.ndarray) -> bytes:
    """One section of (doc_id, number of ids, flags) entries and all their ids."""
    blocks = [ids[k : k + BLOCK] for k in range(0, len(ids), BLOCK)]
    coded = id_coder.encode(blocks)
    table = np.array(entries, ENTRY)
    index = np.array(
        [(len(b), len(w), zlib.crc32(tokens.id_bytes(b))) for b, w in zip(blocks, coded)], INDEX
    )
    head = HEAD.pack(MAGIC, VERSION, len(table), len(index)) + table.tobytes() + index.tobytes()
    body = b"".join(w.astype("<u2").tobytes() for w in coded)
    return head + struct.pack("<I", zlib.crc32(head)) + body


def sections(stream, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(entries, ids) of each section of a file."""

    def exactly(n: int) -> bytes:
        data = stream.read(n)
        if len(data) != n:
            raise ValueError(f"{name} is cut short")
        return data

    while start := stream.read(HEAD.size):
        if len(start) != HEAD.size:
            raise ValueError(f"{name} is cut short")
        magic, version, n_docs, n_blocks = HEAD.unpack(start)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{name} holds no section where one should start")
        tables = exactly(n_docs * ENTRY.itemsize + n_blocks * INDEX.itemsize)
        if zlib.crc32(start + tables) != struct.unpack("<I", exactly(4))[0]:
            raise ValueError(f"{name} has a damaged section header")
        entries = np.frombuffer(tables, ENTRY, n_docs)
        index = np.frombuffer(tables, INDEX, n_blocks, n_docs * ENTRY.itemsize)
        coded = [np.frombuffer(exactly(2 * int(n)), "<u2") for n in index["words"]]
        blocks = id_coder.decode(coded, index["ids"].tolist())
        for k, (block, crc) in enumerate(zip(blocks, index["crc"])):
            if zlib.crc32(tokens.id_bytes(block)) != crc:
                raise ValueError(f"{name} has a damaged block, number {k} of its section")
        yield entries, np.concatenate(blocks)


class _Sections:
    """Collects documents and hands out full sections."""

    def __init__(self):
        self.entries, self.parts, self.size = [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        null = NO_ID if doc_id is None else 0
        while self.size + len(ids) > SECTION:
            room = SECTION - self.size
            self._put(doc_id or 0, ids[:room], null | GOES_ON)
            ids = ids[room:]
            yield self.close()
        self._put(doc_id or 0, ids, null)

    def _put(self, doc_id: int, ids: np.ndarray, flags: int) -> None:
        self.entries.append((doc_id, len(ids), flags))
        self.parts.append(ids)
        self.size += len(ids)

    def close(self) -> bytes:
        data = pack_section(self.entries, np.concatenate(self.parts))
        self.__init__()
        return data


def _write(folder: str, path: str, end_id: int):
    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}.ids"
        own = f"{root}/.{name}-{context.taskAttemptId()}"
        encoder, open_section = tokens.tokenizer(path), _Sections()
        docs = total = 0
        with store.open_output_stream(own) as out:
            for batch in batches:
                for part in tokens.slices(batch):
                    ids, bounds = encoder.encode(part.column("text"))
                    ids = np.insert(ids, bounds[1:], np.uint32(end_id))
                    bounds = bounds + np.arange(len(bounds))
                    for doc, lo, hi in zip(part.column("doc_id").to_pylist(), bounds, bounds[1:]):
                        for data in open_section.add(doc, ids[lo:hi]):
                            out.write(data)
                        docs += 1
                        total += int(hi - lo)
            if open_section.entries:
                out.write(open_section.close())
        store.move(own, f"{root}/{name}")
        yield pa.RecordBatch.from_pydict(
            {"file": [name], "docs": [docs], "ids": [total]},
            pa.schema([("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]),
        )

    return write


def write_ids(
    spark: SparkSession, docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID
) -> DataFrame:
    """Write the documents' ids below ``folder`` by ascending doc_id; the files' manifest."""
    session.ship_package(spark)
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    text = common.text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    row = F.xxhash64("text")
    dealt = rows.repartitionByRange(common.partitions(spark), "doc_id", row)
    ordered = dealt.sortWithinPartitions("doc_id", row)
    write = _write(folder, path or tokens.default_path(), end_id)
    return common.written(spark, ordered.mapInArrow(write, MANIFEST), "manifest")


def _read(with_ids: bool):
    schema = pa.schema(
        [
            ("file", pa.string()), ("place", pa.int64()), ("doc_id", pa.int64()),
            ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary()),
        ]
    )

    def rows_of(path: str) -> Iterator[list[tuple]]:
        store, place = fs.FileSystem.from_uri(path)
        name = path.rsplit("/", 1)[1]
        start = size = crc = 0
        kept: list[bytes] = []
        with store.open_input_stream(place) as stream:
            for entries, ids in sections(stream, path):
                rows, at = [], 0
                for doc_id, n, flags in entries.tolist():
                    data = tokens.id_bytes(ids[at : at + n])
                    at += n
                    size, crc = size + n, zlib.crc32(data, crc)
                    if with_ids:
                        kept.append(data)
                    if not flags & GOES_ON:
                        doc = None if flags & NO_ID else doc_id
                        rows.append((name, start, doc, size, crc, b"".join(kept) if with_ids else None))
                        start, size, crc, kept = start + size, 0, 0, []
                if rows:
                    yield rows

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for rows in rows_of(path):
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return read


def read_ids(
    spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = True
) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 and its ids."""
    session.ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    files = files.select("path").repartition(common.partitions(spark), "path")
    found = files.mapInArrow(_read(with_ids), DECODED)
    # one row per file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return found.join(F.broadcast(bases), "file").select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
