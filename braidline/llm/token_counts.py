"""Tokens of every text, counted by a two-tier lookup of its chunks.

A chunk is a stretch of text whose tokens do not depend on its surroundings
(``tokens`` says where each kind of vocabulary file allows a cut).

First tier: chunks that make up at least 1 / ``ENTRIES`` of all chunks. Every
task counts its chunks in a Misra-Gries summary and reports those that may reach
that share of what the task has read; a chunk with the share overall has it in
some task. Reports are added up, and chunks that still make the share, at most
``ENTRIES``, are encoded once. Their table (text and number of tokens, texts of
at most ``LONGEST`` bytes) is broadcast: at most ``ENTRIES * (LONGEST + 12)``
bytes, whatever the corpus.

Second tier: chunks that are not in the table are encoded where they occur, and
the worker remembers the counts of ``CACHE`` of them. No chunk is shuffled but
for the reports. The table changes the time taken only, never a count.

Defined cases: a null text is empty and has no tokens; equal rows give one
result row each; null doc_ids are kept; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import session
from braidline.llm import common, tokens

LIMIT = 2048
ENTRIES = 1 << 16
LONGEST = 64
SLACK = 4
CACHE = 1_000_000


def _reports(path: str, entries: int):
    def report(batches):
        encoder = tokens.tokenizer(path)
        held: Counter = Counter()
        mass = taken = 0
        for batch in batches:
            for part in tokens.slices(batch):
                chunks, _ = encoder.chunks(part.column("text"))
                mass += len(chunks)
                short = chunks.filter(pc.less_equal(pc.binary_length(chunks), LONGEST))
                counts = pc.value_counts(short)
                held.update(
                    dict(zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist()))
                )
                if len(held) > SLACK * entries:
                    sizes = np.fromiter(held.values(), np.int64, len(held))
                    over = len(held) - SLACK * entries // 2
                    least = int(np.partition(sizes, over - 1)[over - 1])
                    held = Counter({c: n - least for c, n in held.items() if n > least})
                    taken += least
        often = [(c, n) for c, n in held.items() if (n + taken) * entries >= mass]
        columns = zip(*[(None, mass), *often])
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["chunk", "n"])

    return report


def _lengths(path: str):
    def lengths(batches):
        encoder = tokens.tokenizer(path)
        for batch in batches:
            sizes = [len(ids) // 4 for ids in encoder.ids_of(batch.column("chunk").to_pylist())]
            arrays = [batch.column("chunk"), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, ["chunk", "tokens"])

    return lengths


def frequent_lengths(
    spark: SparkSession, texts: DataFrame, path: str, entries: int = ENTRIES
) -> pa.Table:
    """chunk, tokens of the chunks with at least 1 / entries of all chunks."""
    reports = texts.mapInArrow(_reports(path, entries), "chunk string, n long")
    summed = common.written(spark, reports.groupBy("chunk").agg(F.sum("n").alias("n")), "reports")
    mass = summed.where("chunk IS NULL").agg(F.sum("n")).first()[0] or 0
    often = summed.where(F.col("chunk").isNotNull() & (F.col("n") * entries >= mass))
    return often.mapInArrow(_lengths(path), "chunk string, tokens int").toArrow()


class Counts:
    """The two tiers in one worker."""

    def __init__(self, path: str, table: pa.Table):
        self.encoder = tokens.tokenizer(path)
        self.chunks = table.column("chunk").combine_chunks()
        self.sizes = table.column("tokens").to_numpy()
        self.known: dict[str, int] = {}

    def _missed(self, chunks: pa.Array) -> np.ndarray:
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [c for c in distinct if c not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known, new = {}, distinct
        self.known.update(zip(new, (len(ids) // 4 for ids in self.encoder.ids_of(new))))
        sizes = np.fromiter((self.known[c] for c in distinct), np.int64, len(distinct))
        return sizes[coded.indices.to_numpy()]

    def of(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        chunks, bounds = self.encoder.chunks(texts)
        found = pc.index_in(chunks, value_set=self.chunks)
        missing = found.is_null().to_numpy(zero_copy_only=False)
        sizes = np.zeros(len(chunks), np.int64)
        if len(self.sizes):
            sizes[:] = self.sizes[found.fill_null(0).to_numpy()]
        if missing.any():
            sizes[missing] = self._missed(chunks.filter(pa.array(missing)))
        total = np.concatenate([[0], np.cumsum(sizes)])
        return np.diff(total[bounds])


def _counted(path: str, shipped):
    def count(batches):
        counts = Counts(path, shipped.value)
        for batch in batches:
            for part in tokens.slices(batch):
                texts = part.column("text")
                arrays = [
                    part.column("doc_id"),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(counts.of(texts)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_tokens"])

    return count


def count_tokens(
    spark: SparkSession,
    docs: DataFrame,
    path: str | None = None,
    limit: int = LIMIT,
    entries: int = ENTRIES,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    session.ship_package(spark)
    path = path or tokens.default_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    shipped = spark.sparkContext.broadcast(
        frequent_lengths(spark, rows.select("text"), path, entries)
    )
    counted = rows.mapInArrow(_counted(path, shipped), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
