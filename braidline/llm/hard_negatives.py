"""Hard negatives by exact inner products, with candidates cut down by coordinates.

Vectors are rounded to integers, floor(``scale`` * x). A row's score with an anchor is their
inner product; higher scores come first, ties by smaller vec_id. An anchor's
positives are its best rows of the same label; for each of them the negatives
are the best rows of other labels whose score is between ``low`` and ``high``
percent of the positive's.

The rows are range-partitioned by length (ties by vec_id) into segments of at
most about ``SEGMENT`` rows, and a segment into buckets of ``BUCKET`` rows of
similar length. A bucket holds each coordinate as a sorted list. For an anchor
q, a bucket whose longest vector is L long, and a least score t that counts,

- the bucket is left if |q| L < t, and with it all later, shorter ones;
- on each focus coordinate, the anchor's largest ones, a row can make t only if
  its value lies in a range around the anchor's direction: the angle between
  the two is at most arccos(t / |q| L). The sorted lists give the rows in the
  ranges, and only rows in all of them are candidates;
- a candidate's focus coordinates and the length of the rest bound its score;
  who stays is verified exactly.

t grows with what has been found; it starts from the anchors met in the same
block, which are rows themselves. Anchors travel in blocks: each segment meets
each block once. A task keeps one segment and the best few rows of one block.

Defined cases: rows take no part if the label, the vec_id, the vector or a
component is null, a component is not finite, or the integer vector is 2^30 or
more long; a shorter vector counts as filled up with zeros; rows that share a
vec_id each have a place of their own, but none is a partner of its own id;
equal anchor rows are one anchor; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
FOCUS = 6
BUCKET = 8192
SEGMENT = 65_536
ANCHORS = 256
LONGEST = 2.0**60  # squared

NEVER = -(2**62)

_BLOCK = "ids binary, labels binary, dims int, matrix binary"
_STREAM = f"segment int, kind int, {_BLOCK}, numbers binary, bounds binary"


def integer_rows(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v (integer vector), norm (squared) of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x * F.lit(float(scale * scale)))
    rounded = F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("int"))
    ids = [F.col(c).cast("long").alias(c) for c in ("vec_id", "label")]
    return (
        table.select(*ids, v.alias("v"))
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
        .where(finite)
        .where(square < LONGEST)
        .select("vec_id", "label", rounded.alias("v"))
        .withColumn(
            "norm", F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
        )
    )


class Block:
    """Rows with their ids, labels and a matrix of integers."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        self.ids, self.labels, self.matrix = ids, labels, matrix
        self.exact = matrix.astype(np.float64)
        self.squares = np.einsum("ij,ij->i", self.exact, self.exact)

    @classmethod
    def of_rows(cls, batch: pa.RecordBatch) -> "Block":
        vectors = batch.column("v")
        sizes = np.diff(vectors.offsets.to_numpy())
        matrix = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int32)
        matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy()
        return cls(batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), matrix)

    @classmethod
    def unpacked(cls, row: dict) -> "Block":
        ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
        matrix = np.frombuffer(row["matrix"], np.int32).reshape(len(ids), row["dims"])
        return cls(ids, labels, matrix)

    def packed(self) -> dict:
        parts = {"ids": self.ids, "labels": self.labels, "matrix": np.ascontiguousarray(self.matrix)}
        return {k: v.tobytes() for k, v in parts.items()} | {"dims": self.matrix.shape[1]}

    def scores(self, q: np.ndarray, rows) -> np.ndarray:
        """Exact products: a double holds them below 2^53, integers below 2^62."""
        width = min(len(q), self.matrix.shape[1])
        if self.squares.max(initial=0) * float((q.astype(float) ** 2).sum()) < 2.0**104:
            return (self.exact[rows, :width] @ q[:width].astype(np.float64)).astype(np.int64)
        return self.matrix[rows, :width].astype(np.int64) @ q[:width].astype(np.int64)


class Bucket(Block):
    """A block of rows of similar length with a sorted list of each coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        super().__init__(ids, labels, matrix)
        self.order = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.take_along_axis(matrix, self.order.T, axis=0).T.copy()
        self.longest = math.sqrt(self.squares.max(initial=0))

    def candidates(self, q: np.ndarray, length: float, least: int) -> np.ndarray:
        """Rows whose score with q, ``length`` long, may be ``least`` or more."""
        every = np.arange(len(self.ids))
        reach = length * self.longest
        if least > reach * (1 + 1e-9):
            return every[:0]
        if least <= 0 or not reach:
            return every
        spread = math.acos(min(1.0, least / reach)) + 1e-7
        width = min(len(q), self.matrix.shape[1])
        focus = np.argsort(-np.abs(q[:width]), kind="stable")[:FOCUS]
        ranges = []
        for f in focus.tolist():
            angle = math.acos(max(-1.0, min(1.0, q[f] / length)))
            lo = self.longest * math.cos(min(math.pi, angle + spread)) - 1
            hi = self.longest * math.cos(max(0.0, angle - spread)) + 1
            a, b = np.searchsorted(self.sorted[f], [math.floor(lo), math.ceil(hi) + 1])
            if b - a < len(every):
                ranges.append((int(b - a), f, int(a), int(b)))
        rows = every
        if ranges:
            inside = np.zeros(len(every), np.int8)
            for _, f, a, b in ranges:
                inside[self.order[f, a:b]] += 1
            rows = np.flatnonzero(inside == len(ranges))
        near = self.exact[np.ix_(rows, focus)]
        far = np.sqrt(np.maximum(self.squares[rows] - (near * near).sum(axis=1), 0))
        q_near = q[focus].astype(np.float64)
        q_far = math.sqrt(max(length * length - float(q_near @ q_near), 0))
        bound = near @ q_near + q_far * far
        return rows[bound * (1 + 1e-9) + 1 >= least]


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the best scores in order, ties by smaller id."""
    return np.lexsort((ids, -scores))[:most]


class Best:
    """The best few (score, id) so far between two bounds, and the least score that still counts."""

    def __init__(self, most: int, low: int, high: int = 2**62, key: int = 0):
        self.most, self.low, self.high, self.key = most, low, high, key
        self.scores = self.ids = np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        use = (scores >= self.low) & (scores <= self.high)
        if not use.any():
            return
        scores, ids = np.append(self.scores, scores[use]), np.append(self.ids, ids[use])
        top = best(scores, ids, self.most)
        self.scores, self.ids = scores[top], ids[top]
        if len(top) == self.most:
            self.low = max(self.low, int(self.scores[-1]))


def search(buckets: list[Bucket], anchors: Block, wanted: list[list[Best]], same: bool) -> None:
    """Add the rows of the buckets, longest first, to the lists of each anchor."""
    for i, lists in enumerate(wanted):
        if not lists:
            continue
        q, length = anchors.matrix[i], math.sqrt(anchors.squares[i])
        for bucket in buckets:
            least = min(x.low for x in lists)
            if least > length * bucket.longest * (1 + 1e-9):
                break
            rows = bucket.candidates(q, length, least)
            rows = rows[(bucket.labels[rows] == anchors.labels[i]) == same]
            rows = rows[bucket.ids[rows] != anchors.ids[i]]
            if len(rows):
                scores, ids = bucket.scores(q, rows), bucket.ids[rows]
                for x in lists:
                    x.add(scores, ids)


def _segments(bucket_rows: int):
    def pack(batches):
        segment = TaskContext.get().partitionId()
        for batch in _of_size(batches, bucket_rows):
            yield _stream([{"segment": segment, "kind": 0} | Block.of_rows(batch).packed()])

    return pack


def _of_size(batches, rows: int):
    """The same rows in batches of ``rows``, but for the last."""
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_KINDS = pa.schema(
    [("segment", pa.int32()), ("kind", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
     ("dims", pa.int32()), ("matrix", pa.binary()), ("numbers", pa.binary()), ("bounds", pa.binary())]
)


def _stream(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _KINDS)


def _anchor_blocks(positives: int):
    def pack(batches):
        for batch in _of_size(batches, ANCHORS):
            block = Block.of_rows(batch)
            bounds = np.full(len(block.ids), NEVER, np.int64)
            for i, q in enumerate(block.matrix):
                other = np.flatnonzero((block.labels == block.labels[i]) & (block.ids != block.ids[i]))
                if len(other) >= positives:
                    bounds[i] = np.sort(block.scores(q, other))[-positives]
            row = {"kind": 1, "numbers": batch.column("anchor").to_numpy().tobytes(), "bounds": bounds.tobytes()}
            yield _stream([row | block.packed()])

    return pack


def _bounded_blocks(batches):
    """Blocks of anchors with the scores of their positives in front of the negatives' search."""
    for batch in _of_size(batches, ANCHORS):
        lists = batch.column("scores")
        sizes = np.diff(lists.offsets.to_numpy())
        width = int(sizes.max(initial=0))
        bounds = np.full((batch.num_rows, width), NEVER, np.int64)
        bounds[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
        row = {"kind": 1, "numbers": batch.column("anchor").to_numpy().tobytes(), "bounds": bounds.tobytes()}
        yield _stream([row | Block.of_rows(batch).packed()])


FOUND = "anchor long, bound long, score long, vec_id long"


def _search(same: bool, most: int, low: int, high: int):
    def lists_of(bounds: np.ndarray) -> list[list[Best]]:
        if same:
            return [[Best(most, int(b))] for b in bounds[:, 0]]
        lists = []
        for row in bounds:
            scores = {int(b) for b in row if b != NEVER}
            windows = [(-(-low * s // 100), high * s // 100, s) for s in sorted(scores)]
            lists.append([Best(most, a, b, s) for a, b, s in windows if a <= b])
        return lists

    def rows_of(numbers: np.ndarray, wanted: list[list[Best]]) -> pa.RecordBatch:
        rows = [
            (number, x.key, score, vec_id)
            for number, lists in zip(numbers.tolist(), wanted)
            for x in lists
            for score, vec_id in zip(x.scores.tolist(), x.ids.tolist())
        ]
        arrays = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [()] * 4)]
        return pa.RecordBatch.from_arrays(arrays, ["anchor", "bound", "score", "vec_id"])

    def run(batches):
        segment, buckets = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                if row["segment"] != segment:
                    segment, buckets = row["segment"], []
                if row["kind"] == 0:
                    buckets.append(Bucket.unpacked(row))
                    buckets.sort(key=lambda b: -b.longest)
                    continue
                if not buckets:
                    continue
                anchors = Block.unpacked(row)
                numbers = np.frombuffer(row["numbers"], np.int64)
                bounds = np.frombuffer(row["bounds"], np.int64).reshape(len(numbers), -1)
                wanted = lists_of(bounds)
                search(buckets, anchors, wanted, same)
                yield rows_of(numbers, wanted)

    return run


def _met(segments: DataFrame, top: int, blocks: DataFrame, search_in) -> DataFrame:
    """What the search finds when every block of anchors meets every segment."""
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(top)))
    dealt = blocks.drop("segment").select(everywhere.alias("segment"), "*")
    both = segments.unionByName(dealt)
    # a task holds the buckets of its segment when the blocks come
    met = both.repartitionById(top + 1, F.col("segment")).sortWithinPartitions("segment", "kind")
    return met.mapInArrow(search_in, FOUND)


def _top(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine(
    spark: SparkSession,
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    bucket_rows: int = BUCKET,
    segment_rows: int = SEGMENT,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` are ``integer_rows``; the anchors are some of the rows.
    """
    session.ship_package(spark)
    rows = common.written(spark, rows, "vectors")
    n = rows.count()
    # small tables are shared out as far as buckets of a useful size go
    wanted = max(math.ceil(n / segment_rows), min(common.partitions(spark), math.ceil(n / bucket_rows)), 1)
    by_length = rows.repartitionByRange(wanted, F.desc("norm"), "vec_id")
    by_length = by_length.sortWithinPartitions(F.desc("norm"), "vec_id").select("vec_id", "label", "v")
    segments = common.written(spark, by_length.mapInArrow(_segments(bucket_rows), _STREAM), "segments")
    top = segments.agg(F.max("segment")).first()[0] or 0

    chosen = anchors.select("vec_id", "label", "v").distinct()
    chosen = chosen.withColumn("anchor", F.monotonically_increasing_id())
    chosen = common.written(spark, chosen, "anchors")
    blocks = common.written(spark, chosen.mapInArrow(_anchor_blocks(positives), _STREAM), "anchor-blocks")
    best_same = _met(segments, top, blocks, _search(True, positives, low, high))
    positive = _top(best_same, ["anchor"], positives).select(
        "anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "rank"
    )
    positive = common.written(spark, positive, "positives")

    bounded = chosen.join(
        positive.groupBy("anchor").agg(F.collect_set("positive_score").alias("scores")), "anchor"
    )
    blocks = bounded.select("anchor", "vec_id", "label", "v", "scores").mapInArrow(_bounded_blocks, _STREAM)
    blocks = common.written(spark, blocks, "bounded-blocks")
    found = _met(segments, top, blocks, _search(False, negatives, low, high))
    negative = _top(found, ["anchor", "bound"], negatives).select(
        "anchor",
        F.col("bound").alias("positive_score"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    named = positive.drop("rank").join(
        chosen.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor"
    )
    return named.join(negative, ["anchor", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
