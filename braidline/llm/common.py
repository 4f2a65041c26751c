"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import session

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
LEAST_ID = -(2**63)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage."""
    path = session.scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column in ``taken`` has it; Spark ignores case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries that are over.

    It does so when the driver collects its garbage, which it may not do for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is.

    ``lower`` is much faster than ``translate`` and equals it unless the text
    holds a capital letter outside A-Z.
    """
    other_capital = text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(other_capital, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words(text: Column, gap: str = WHITE_RUN) -> Column:
    """The array of words between runs of ``gap``."""
    return F.array_remove(F.split(text, gap), "")


def let(value: Column, body) -> Column:
    """``body`` over ``value``, which is computed once however often body names it."""
    return F.transform(F.array(value), body)[0]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pair_key(value: Column) -> list[Column]:
    """128 bits of hash as two columns h1, h2."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")]
