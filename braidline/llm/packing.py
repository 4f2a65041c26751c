"""Pack documents into token sequences of a fixed capacity by sum of squares.

A document is its ids and an end id. Documents longer than a sequence are cut
into full pieces, each a sequence of its own, and a rest. Pieces are placed one by
one: into the open bin, or a new one, for which the sum over all residual gaps
of the squared number of open bins with that gap becomes smallest. That keeps bins of many different gaps open, so most later pieces
find one that they fill exactly.

Tokenizing runs over partitions of documents and writes one small row per
piece. Pieces are dealt at random, by hash, into groups of about PER_GROUP;
each group is packed by one task, which holds only sizes. A group can leave
only its few last bins unfilled, so sequences beyond the least possible number
do not grow with the group size.

Defined cases: a null or empty text is its end id alone; equal rows are pieces
of their own, told apart by their place in the input; null doc_ids are kept; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common, tokens

CAPACITY = 4096
END_ID = 1
PER_GROUP = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, capacity: int, end_id: int):
    def cut(batches):
        encoder = tokens.tokenizer(path)
        for batch in batches:
            for part in tokens.slices(batch):
                ids, bounds = encoder.encode(part.column("text"))
                rows = []
                for doc, lo, hi in zip(part.column("doc_id").to_pylist(), bounds, bounds[1:]):
                    whole = np.append(ids[lo:hi], np.uint32(end_id))
                    for k, start in enumerate(range(0, len(whole), capacity)):
                        piece = whole[start : start + capacity]
                        crc = zlib.crc32(tokens.id_bytes(piece))
                        rows.append((doc, k, start, len(piece), crc))
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return cut


def pieces(
    spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    session.ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    return rows.mapInArrow(_cut(path, capacity, end_id), PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in the given order."""
    n_open = np.zeros(capacity + 1, np.int64)  # open bins by residual gap
    holders: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for k, size in enumerate(lengths.tolist()):
        # putting it into a gap g changes the sum by 2 (N[g - size] - N[g]) + 2;
        # gap 0 is not open and counts nothing: 1 - 2 N[g]
        gaps = np.flatnonzero(n_open[size:]) + size
        change = 2 * (n_open[gaps - size] - n_open[gaps]) + 2
        if len(gaps) and gaps[0] == size:
            change[0] = 1 - 2 * n_open[size]
        rest = capacity - size
        new = 2 * n_open[rest] + 1 if rest else 0
        if len(gaps) and change[best := int(np.argmin(change))] <= new:
            gap = int(gaps[best])
            bin_id = holders[gap].pop()
            n_open[gap] -= 1
        else:
            gap, bin_id = capacity, made
            made += 1
        bins[k], offsets[k] = bin_id, capacity - gap
        if gap > size:
            n_open[gap - size] += 1
            holders[gap - size].append(bin_id)
    return bins, offsets


def fewest(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of squares with the largest first and in a shuffled order; the fewer bins win.

    Largest first leaves less open at the end of a short list, a mixed order fits
    a long one better.
    """
    orders = [
        np.argsort(-lengths, kind="stable"),
        np.random.default_rng(len(lengths)).permutation(len(lengths)),
    ]
    best = None
    for order in orders:
        bins, offsets = sum_of_squares(lengths[order], capacity)
        if best is None or bins.max() < best[0].max():
            back = np.argsort(order)
            best = bins[back], offsets[back]
    return best


def _pack_group(capacity: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by(
            [(c, "ascending") for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
        )
        number = group.column("grp")[0].as_py() << 40
        bins, offsets = fewest(group.column("length").to_numpy(), capacity)
        packed = group.drop_columns("grp")
        packed = packed.append_column("sequence_id", pa.array(bins + number))
        return packed.append_column("offset", pa.array(offsets))

    return pack


def pack(
    spark: SparkSession,
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    per_group: int = PER_GROUP,
) -> DataFrame:
    """One row per piece with its sequence_id and offset there."""
    found = pieces(spark, docs, path or tokens.default_path(), capacity, end_id)
    found = common.written(spark, found, "pieces")
    groups = max(1, math.ceil(found.count() / per_group))
    # equal rows differ in their position only, so the deal includes a row number
    dealt = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups))
    return (
        found.withColumn("grp", dealt)
        .groupBy("grp")
        .applyInArrow(_pack_group(capacity), PIECES + ", sequence_id long, offset long")
    )
