"""The corpus pipeline: from raw documents to packed token sequences.

Each stage works on all documents that the one before kept. The stages before
the last return the columns of ``documents``; run() writes what a stage returns
and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from braidline import session
from braidline.llm import common, decontaminate, line_dedup, packing, simhash, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned lexicon scores 0.7 or more go."""
    return toxicity.without_toxic(spark, docs, common.read(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least 20 characters in at least 3 documents stay in the latest one only."""
    return line_dedup.without_lines(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints or by a five-word similarity of 0.8, the one with the least doc_id stays."""
    return simhash.keep_one(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.without_contaminated(spark, docs, common.read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents left, packed into sequences of 4096."""
    return packing.pack(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

# learned scores, a walk of tries and a packing heuristic are not SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    session.ship_package(spark)
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(spark, stage(spark, docs, sf_dir), name)
    return docs
