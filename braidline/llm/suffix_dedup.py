"""Remove byte strings that an earlier document holds, by prefix doubling.

Every byte that lies in a LENGTH-byte string which also starts in a document
with a smaller doc_id goes; the strings are those of the input.

Prefix doubling names the string of a given length at each position and builds
the names of longer strings from pairs of names, dropping positions as soon as
their name is unique. Three things keep it small:

- Names are hashes, so equal strings have equal names without a global rank;
  Spark sorts (name, slice, least doc_id) rows to find names that repeat.
- The first round takes place at anchors only. Of the SEED-byte strings inside
  a LENGTH-byte string, the one with the least hash is its anchor, so equal
  strings have equal anchors, and about one position in 17 is one. Most anchors
  have a unique name and go.
- The second round names spans: from one anchor left to the end of the LENGTH
  bytes that start at the next one. A span that an earlier document holds settles
  all strings inside it, there as a removal and for later documents as well, for
  whom the earlier document speaks. In a long repeated passage spans leave only
  its ends. What stays open are strings around the ends, or around anchors that
  repeat by chance: those not settled whose anchor repeats. For their anchors, in
  all documents, the names double to both sides: the strings of twice the SEED
  before and behind. Only strings that are not settled and all of whose doubled
  parts repeat are named in the last round.

The texts are written once as a table of slices, consecutive documents with at
most SLICE_BYTES of text, and with each text its anchors and how many strings have
each of them. Each round reads them where they lie and hashes only the strings that
it names, so no round but the writing one looks at every position. A slice sends a
name once, with its least doc_id, however often it occurs, so that a string in
a third of all documents costs one row per slice. Names found in several slices
go back to the part of the table that they came from, as files beside it.

Names have 64 bits where a chance collision only makes more work, that is for
anchors and doubled strings, and 96 bits for spans and whole strings.

Defined cases: a null text is empty; texts shorter than LENGTH bytes lose
nothing; null doc_ids together are one document before all others; rows that
share a doc_id are one document, each row with a result of its own; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common, tokens

LENGTH = 50
SEED = 16
SLICE_BYTES = 4 << 20
ROW_GROUP = 1 << 30  # more than a part of the table, so that no slice is split

U = np.uint64
_FACTORS = (
    (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)),
    (U(0xC2B2AE3D27D4EB4F), U(0xA24BAED4963EE407)),
)
WORD = 8
BLOCK = 1 << 15  # strings named at once, so that their hashes stay in the cache

SLICES = "part int, slice int, doc_id long, text string, runs binary"
# the columns that differ stand side by side, which packs better in a shuffle
SEED_NAMES = "name long, least long, slice long"
NAMES = "name long, more int, least long, slice long"
PER_PART = 1 << 20  # a slice's id is its part times this, and its number there
REPLY = "slice int, name long, least long, part int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def padded(texts: list[bytes]) -> np.ndarray:
    """The bytes of all texts, and some zeros behind them, so that a word starts at each byte."""
    return np.frombuffer(b"".join([*texts, bytes(WORD)]), np.uint8)


def words(data: np.ndarray) -> np.ndarray:
    """The word that starts at each byte of padded data; words overlap."""
    return np.ndarray(len(data) - WORD + 1, "<u8", data, strides=(1,))


def _mix(h: np.ndarray, which: int) -> np.ndarray:
    first, second = _FACTORS[which]
    h *= first
    h ^= h >> U(32)
    h *= second
    h ^= h >> U(29)
    return h


def _names(word: np.ndarray, starts: np.ndarray, sizes, which: int) -> np.ndarray:
    longest = int(np.max(sizes))
    out = _mix(np.full(len(starts), sizes, U) + U(1), which)
    last = np.maximum(np.asarray(sizes, np.int64) - WORD, 0)
    for k in range(0, longest, WORD):
        found = word[starts + np.minimum(last, k)]
        if k == 0 and np.min(sizes) < WORD:
            found &= (U(2) << (np.minimum(sizes, WORD) * 8 - 1).astype(U)) - U(1)
        mixed = _mix(out ^ found, which)
        out = mixed if np.ndim(sizes) == 0 else np.where(sizes > k, mixed, out)
    return out


def names(word: np.ndarray, starts: np.ndarray, sizes, which: int = 0) -> np.ndarray:
    """Hash of the ``sizes`` bytes from each start, word by word; the last word may overlap."""
    out = np.empty(len(starts), U)
    for at in range(0, len(starts), BLOCK):
        of = slice(at, at + BLOCK)
        out[of] = _names(word, starts[of], sizes if np.ndim(sizes) == 0 else sizes[of], which)
    return out


def sliding(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each ``n`` consecutive values."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if width < n else x


def anchor_offsets(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """How far behind its start the anchor of each ``length``-byte string lies.

    The anchor is the first of the seeds with the least hash; hashes have 48 bits
    here, and the place in the block below them settles ties.
    """
    span = length - seed + 1
    n = len(data) - WORD - length + 1
    out = np.empty(max(n, 0), np.min_scalar_type(span))
    word, place = words(data), np.arange(BLOCK + span, dtype=U)
    mask = U(2 ** (8 * min(seed, WORD)) - 1)
    for at in range(0, n, BLOCK):
        size = min(BLOCK, n - at)
        seeds = size + span - 1
        h = np.full(seeds, U(seed))
        for k in range(0, seed, WORD):
            from_ = at + max(min(k, seed - WORD), 0)
            h ^= word[from_ : from_ + seeds] & mask
            _mix(h, 0)
        key = h & ~U(0xFFFF) | place[:seeds]
        out[at : at + size] = (sliding(key, span) & U(0xFFFF)) - place[:size]
    return out


def runs(texts: list[bytes], length: int, seed: int) -> list[bytes]:
    """Per text, its runs of strings that share an anchor.

    A run is the offset of the anchor from its first string and the number of its
    strings; first all offsets, then all numbers.
    """
    kind = np.min_scalar_type(length - seed + 1)
    sizes = np.array([len(t) for t in texts], np.int64)
    offset = anchor_offsets(padded(texts), length, seed)
    strings = np.maximum(sizes - length + 1, 0)
    ends = np.cumsum(sizes)
    new = np.ones(len(offset) + 1, bool)
    new[1 : len(offset)] = offset[1:] + kind.type(1) != offset[:-1]
    out = []
    for first, n in zip((ends - sizes).tolist(), strings.tolist()):
        if not n:
            out.append(b"")
            continue
        new[first] = True
        starts = np.flatnonzero(new[first : first + n])
        numbers = np.diff(starts, append=n).astype(kind)
        out.append(offset[first + starts].tobytes() + numbers.tobytes())
    return out


class Slice:
    """The texts of consecutive rows as one byte array, and their anchors.

    Anchor k is that of ``count[k]`` strings from ``first[k]`` on, and lies at ``at[k]``.
    """

    def __init__(self, doc_ids: list, texts: list[bytes], found: list[bytes], length: int, seed: int):
        self.length = length
        self.texts = texts
        self.ids = np.array([common.LEAST_ID if d is None else d for d in doc_ids], np.int64)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.data = padded(texts)
        self.word = words(self.data)
        self.ends = np.cumsum(self.sizes)
        self.n = int(self.sizes.sum())
        kind = np.min_scalar_type(length - seed + 1)
        per_text = np.array([len(r) // (2 * kind.itemsize) for r in found], np.int64)
        halves = np.frombuffer(b"".join(found), kind)
        self.text = np.repeat(np.arange(len(texts)), per_text)
        last = np.cumsum(per_text)
        # where the offsets of an anchor's text start, and its place among them
        own = np.arange(len(self.text)) + np.repeat(last - per_text, per_text)
        self.count = halves[own + np.repeat(per_text, per_text)].astype(np.int64)
        before = np.cumsum(self.count) - self.count
        base = (self.ends - self.sizes)[per_text > 0] - before[(last - per_text)[per_text > 0]]
        self.first = before + np.repeat(base, per_text[per_text > 0])
        self.at = self.first + halves[own]
        self.docs = self.ids[self.text]
        self.seeds = names(self.word, self.at, seed)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.ends, at, side="right")]

    def names_of(self, at: np.ndarray, size) -> list[np.ndarray]:
        """Both halves of the names of the strings of ``size`` bytes at the given positions."""
        return [names(self.word, at, size, k) for k in (0, 1)]

    def strings(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all strings that have one of the anchors, and its number for each."""
        count = self.count[anchors]
        anchor = np.repeat(anchors, count)
        ramp = np.arange(len(anchor)) - np.repeat(np.cumsum(count) - count, count)
        return self.first[anchor] + ramp, anchor


def least_docs(name: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names, the least document of each, and which of them each row has."""
    which = np.empty(len(name), np.int64)
    if not len(name):
        return name, docs, which
    order = np.argsort(name)
    ordered = name[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    which[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return ordered[first], np.minimum.reduceat(docs[order], first), which


class Replies:
    """Names that came back to a part of the table: per slice, names and least documents."""

    def __init__(self, folder: str):
        self.folder, self.part = folder, None

    def of(self, part: int, number: int) -> tuple[np.ndarray, np.ndarray]:
        if part != self.part:
            store, root = fs.FileSystem.from_uri(self.folder)
            place = f"{root}/part={part}"
            if store.get_file_info(place).type == fs.FileType.Directory:
                table = ds.dataset(place, filesystem=store, format="parquet").to_table(
                    columns=["slice", "name", "least"]
                )
            else:
                table = pa.table({c: pa.array([], pa.int64()) for c in ("slice", "name", "least")})
            columns = [table.column(c).to_numpy() for c in ("slice", "name", "least")]
            order = np.argsort(columns[0], kind="stable")
            self.part = part
            self.slices, self.names, self.least = (c[order] for c in columns)
        lo, hi = np.searchsorted(self.slices, [number, number + 1])
        known = self.names[lo:hi].view(U)
        order = np.argsort(known)
        return known[order], self.least[lo:hi][order]


def earliest(name: np.ndarray, docs: np.ndarray, reply: tuple) -> np.ndarray:
    """The least document that holds each row's name, here or elsewhere."""
    distinct, least, which = least_docs(name, docs)
    known, elsewhere = reply
    if len(known) and len(distinct):
        at = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
        least = np.where(known[at] == distinct, np.minimum(least, elsewhere[at]), least)
    return least[which]


def is_in(name: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which names are among the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(name), bool)
    return known[np.minimum(np.searchsorted(known, name), len(known) - 1)] == name


def in_several(name: np.ndarray, docs: np.ndarray, elsewhere: np.ndarray) -> np.ndarray:
    """Which names several documents hold, here or in other slices."""
    distinct, least, which = least_docs(name, docs)
    several = is_in(distinct, elsewhere)
    several[which[docs != least[which]]] = True
    return several[which]


def between(piece: Slice, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in any of the ranges [start, end)."""
    change = np.zeros(piece.n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1], dtype=np.int32) > 0


class Rounds:
    """What a slice does in each round; holds where the replies of earlier rounds lie."""

    def __init__(self, length: int, seed: int):
        self.length, self.seed = length, seed
        self.anchors = self.spans = self.ends = self.halves = self.last = None

    def slices(self, batches) -> Iterator[tuple[int, int, Slice]]:
        key, ids, texts, found = None, [], [], []
        for batch in batches:
            columns = [c.cast(pa.binary()) if pa.types.is_string(c.type) else c for c in batch.columns]
            for part, number, doc, text, run in zip(*(c.to_pylist() for c in columns)):
                if key is not None and key != (part, number):
                    yield *key, Slice(ids, texts, found, self.length, self.seed)
                    ids, texts, found = [], [], []
                key = part, number
                ids.append(doc)
                texts.append(text)
                found.append(run)
        if key is not None:
            yield *key, Slice(ids, texts, found, self.length, self.seed)

    @staticmethod
    def rows(part: int, number: int, name, more, docs) -> pa.RecordBatch:
        """One row per distinct name with its least document, by document, which packs best."""
        distinct, least, which = least_docs(name, docs)
        order = np.argsort(least, kind="stable")
        columns = {"name": distinct.view(np.int64)[order]}
        if more is not None:
            of = np.empty(len(distinct), np.int32)
            of[which] = (more >> U(32)).astype(np.uint32).view(np.int32)
            columns["more"] = of[order]
        columns["least"] = least[order]
        columns["slice"] = np.full(len(distinct), part * PER_PART + number, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    def cut(self, batches):
        """Number consecutive rows by slices of at most SLICE_BYTES, and add their runs."""
        part, number, held = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for piece in tokens.slices(batch):
                texts = piece.column("text").cast(pa.binary()).to_pylist()
                numbers = []
                for size in map(len, texts):
                    if held and held + size > SLICE_BYTES:
                        number, held = number + 1, 0
                    held += size
                    numbers.append(number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(numbers), pa.int32()),
                        pa.array(numbers, pa.int32()),
                        piece.column("doc_id"),
                        piece.column("text"),
                        pa.array(runs(texts, self.length, self.seed), pa.binary()),
                    ],
                    ["part", "slice", "doc_id", "text", "runs"],
                )

    def name_anchors(self, batches):
        for part, number, piece in self.slices(batches):
            yield self.rows(part, number, piece.seeds, None, piece.docs)

    def _repeated_anchors(self, part: int, number: int, piece: Slice, replies: Replies):
        """Numbers of the anchors that several documents have, and every anchor's least document."""
        known, elsewhere = replies.of(part, number)
        distinct, least, which = least_docs(piece.seeds, piece.docs)
        found = is_in(distinct, known)
        several = found.copy()
        several[which[piece.docs != least[which]]] = True
        least[found] = np.minimum(least[found], elsewhere[np.searchsorted(known, distinct[found])])
        return np.flatnonzero(several[which]), least[which]

    def _spans(self, piece: Slice, several: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last string start of the spans between neighbouring anchors that repeat."""
        pairs = several[:-1][np.diff(several) == 1]
        first, last = piece.at[pairs], piece.at[pairs + 1]
        inside = (last + self.length <= piece.ends[piece.text[pairs]]) & (last - first <= self.length)
        return first[inside], last[inside]

    def name_spans(self, batches):
        replies = Replies(self.anchors)
        for part, number, piece in self.slices(batches):
            several, _ = self._repeated_anchors(part, number, piece, replies)
            first, last = self._spans(piece, several)
            if len(first):
                name = piece.names_of(first, last - first + self.length)
                yield self.rows(part, number, *name, piece.doc_of(first))

    def _state(self, part: int, number: int, piece: Slice, anchors: Replies, spans: Replies):
        """Bytes that spans cover; which starts they settle; open strings and their anchors."""
        several, earliest_seed = self._repeated_anchors(part, number, piece, anchors)
        gone = np.zeros(piece.n, bool)
        settled = np.zeros(piece.n, bool)
        none = np.empty(0, np.int64)
        if not len(several):
            return gone, settled, none, none
        first, last = self._spans(piece, several)
        if len(first):
            name = names(piece.word, first, last - first + self.length)
            docs = piece.doc_of(first)
            repeats = earliest(name, docs, spans.of(part, number)) < docs
            gone = between(piece, first[repeats], last[repeats] + self.length)
            settled = between(piece, first[repeats], last[repeats] + 1)
        whole, anchor = piece.strings(several[earliest_seed[several] < piece.docs[several]])
        left = np.concatenate([[0], np.cumsum(~gone, dtype=np.int32)])
        opened = ~settled[whole] & (left[whole + self.length] > left[whole])
        return gone, settled, whole[opened], anchor[opened]

    def open_anchors(self, batches):
        """Names of the anchors of open strings."""
        anchors, spans = Replies(self.anchors), Replies(self.spans)
        for part, number, piece in self.slices(batches):
            _, _, _, anchor = self._state(part, number, piece, anchors, spans)
            name = np.unique(piece.seeds[anchor])
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64))], ["name"])

    @staticmethod
    def _known(part: int, number: int, opened: np.ndarray, ends: Replies) -> np.ndarray:
        """Names of anchors of open strings, here or elsewhere."""
        return np.union1d(ends.of(part, number)[0], opened)

    def _halves(self, piece: Slice, known: np.ndarray):
        """Per side, the anchors with a known name that have room, and where their string starts."""
        number = np.flatnonzero(is_in(piece.seeds, known))
        at, text = piece.at[number], piece.text[number]
        behind = at + 2 * self.seed <= piece.ends[text]
        before = at - self.seed >= (piece.ends - piece.sizes)[text]
        return (number[behind], at[behind]), (number[before], at[before] - self.seed)

    def name_halves(self, batches):
        anchors, spans, ends = (Replies(x) for x in (self.anchors, self.spans, self.ends))
        for part, number, piece in self.slices(batches):
            _, _, _, anchor = self._state(part, number, piece, anchors, spans)
            known = self._known(part, number, piece.seeds[anchor], ends)
            if len(known) and len(piece.at):
                at = np.unique(np.concatenate([start for _, start in self._halves(piece, known)]))
                if len(at):
                    name = names(piece.word, at, 2 * self.seed)
                    yield self.rows(part, number, name, None, piece.doc_of(at))

    def _around_open(self, part: int, number: int, piece: Slice, opened, ends, halves):
        """Strings whose anchor is that of an open string, and whose doubled parts repeat."""
        known = self._known(part, number, opened, ends)
        if not len(known) or not len(piece.at):
            return np.empty(0, np.int64)
        repeats = []
        elsewhere = halves.of(part, number)[0]
        sides = self._halves(piece, known)
        starts = np.concatenate([start for _, start in sides])
        if not len(starts):
            return np.empty(0, np.int64)
        name = names(piece.word, starts, 2 * self.seed)
        several = in_several(name, piece.doc_of(starts), elsewhere)
        for (numbers, _), found in zip(sides, np.split(several, [len(sides[0][0])])):
            flag = np.zeros(len(piece.at), bool)
            flag[numbers] = found
            repeats.append(flag)
        whole, anchor = piece.strings(np.flatnonzero(is_in(piece.seeds, known)))
        off = piece.at[anchor] - whole
        behind = repeats[0][anchor] | (off + 2 * self.seed > self.length)
        before = repeats[1][anchor] | (off < self.seed)
        return whole[behind & before]

    def name_around_open(self, batches):
        anchors, spans, ends, halves = (
            Replies(x) for x in (self.anchors, self.spans, self.ends, self.halves)
        )
        for part, number, piece in self.slices(batches):
            _, settled, _, anchor = self._state(part, number, piece, anchors, spans)
            at = self._around_open(part, number, piece, piece.seeds[anchor], ends, halves)
            at = at[~settled[at]]
            if len(at):
                yield self.rows(part, number, *piece.names_of(at, self.length), piece.doc_of(at))

    def results(self, batches, with_kept: bool):
        *replies, last = [
            Replies(x) for x in (self.anchors, self.spans, self.ends, self.halves, self.last)
        ]
        for part, number, piece in self.slices(batches):
            gone, settled, _, anchor = self._state(part, number, piece, *replies[:2])
            at = self._around_open(part, number, piece, piece.seeds[anchor], *replies[2:])
            at = at[~settled[at]]
            if len(at):
                name, docs = names(piece.word, at, self.length), piece.doc_of(at)
                repeats = earliest(name, docs, last.of(part, number)) < docs
                gone = gone | between(piece, at[repeats], at[repeats] + self.length)
            yield self._result(piece, gone, with_kept)

    @staticmethod
    def _result(piece: Slice, gone: np.ndarray, with_kept: bool) -> pa.RecordBatch:
        rows = []
        for doc, text, end in zip(piece.ids.tolist(), piece.texts, piece.ends.tolist()):
            mask = gone[end - len(text) : end]
            removed = int(np.count_nonzero(mask))
            spans, kept = 0, text
            if removed:
                spans = int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1]))
                kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
            rows.append(
                (
                    None if doc == common.LEAST_ID else doc, len(text), removed, spans,
                    hashlib.sha256(kept).hexdigest(), kept if with_kept else None,
                )
            )
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        fields = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(arrays, fields)


def _send_back(spark: SparkSession, rows: DataFrame, label: str) -> str:
    """Write (slice, name, least) rows as files by part; what the round shuffled may go then."""
    path = session.scratch_path(spark, label)
    dealt = rows.select("slice", "name", "least", "part").repartition(
        common.partitions(spark), "part"
    )
    dealt.write.option("compression", "zstd").partitionBy("part").parquet(path)
    common.release(spark)
    return path


def _in_several_slices(rows: DataFrame, only_later: bool) -> DataFrame:
    """Sort names and keep those of several slices, with the least document of all.

    With ``only_later``, a slice that holds that document itself gets no answer.
    """
    same = Window.partitionBy(*[c for c in rows.columns if c in ("name", "more")])
    return (
        rows.select(
            "slice",
            "name",
            F.col("least").alias("own"),
            F.min("least").over(same).alias("least"),
            F.count("*").over(same).alias("slices"),
        )
        .where("least < own" if only_later else "slices > 1")
        .select(
            F.expr(f"cast(slice div {PER_PART} as int)").alias("part"),
            F.expr(f"cast(slice % {PER_PART} as int)").alias("slice"),
            "name",
            "least",
        )
    )


def remove_repeats(
    spark: SparkSession,
    docs: DataFrame,
    length: int = LENGTH,
    seed: int = SEED,
    with_kept: bool = True,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the bytes kept."""
    session.ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    path = session.scratch_path(spark, "slices")
    rounds = Rounds(length, seed)
    writer = rows.mapInArrow(rounds.cut, SLICES).write.option("compression", "zstd")
    writer.option("parquet.block.size", ROW_GROUP).parquet(path)
    table = spark.read.parquet(path)

    def named(step, schema: str, label: str, only_later: bool = False) -> str:
        found = _in_several_slices(table.mapInArrow(step, schema), only_later)
        return _send_back(spark, found, label)

    rounds.anchors = named(rounds.name_anchors, SEED_NAMES, "anchors")
    rounds.spans = named(rounds.name_spans, NAMES, "spans", True)
    opened = table.mapInArrow(rounds.open_anchors, "name long").distinct()
    anchors = spark.read.schema(REPLY).parquet(rounds.anchors)
    rounds.ends = _send_back(spark, anchors.join(opened, "name", "left_semi"), "ends")
    rounds.halves = named(rounds.name_halves, SEED_NAMES, "halves")
    rounds.last = named(rounds.name_around_open, NAMES, "around", True)
    return table.mapInArrow(lambda batches: rounds.results(batches, with_kept), RESULT)
