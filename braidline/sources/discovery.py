"""Finding runs, episodes and sessions from file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import schemas


def list_files(spark: SparkSession, root: str | list[str], pattern: str = "*") -> DataFrame:
    """Path and size of every file below ``root``; no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def discover_episodes(files: DataFrame) -> DataFrame:
    """Run and episode index named in the paths, each once."""
    found = r"([^/]+)/(?:raw/|pipeline/)[^/]+/episode_(\d+)/"
    return (
        files.select(
            F.regexp_extract("path", found, 1).alias("run_id"),
            F.regexp_extract("path", found, 2).try_cast("long").alias("source_episode_index"),
        )
        .where(F.col("source_episode_index").isNotNull())
        .distinct()
    )


def complete_sessions(files: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Sessions whose directory holds every required file, and what the others lack."""
    required = required or schemas.SESSION_FILES
    named = files.select(
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("session"),
        F.regexp_extract("path", r"/([^/]+)$", 1).alias("_file"),
    )
    seen = named.groupBy("session").agg(
        *[F.bool_or(F.col("_file") == r).alias(f"_{i}") for i, r in enumerate(required)]
    )
    lacking = F.array_compact(
        F.array(*[F.when(~F.col(f"_{i}"), F.lit(r)) for i, r in enumerate(required)])
    )
    return seen.select(
        "session",
        (F.size(lacking) == 0).alias("complete"),
        F.array_join(lacking, ",").alias("missing"),
    )
