"""Phone sessions as their receiver left them: what the durable commit covers.

The commit marker of a session names, for each of its files, how many bytes are
safely on disk. Rows behind them may be torn and do not count; a file that is
shorter than that, or a marker that fails its check, makes the session an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline import schemas
from braidline.sources import text


def _number(content: Column, at: int, size: int) -> Column:
    """A big-endian unsigned number."""
    return F.conv(F.hex(F.substring(content, at + 1, size)), 16, 10).cast("long")


def _folder(path: Column) -> Column:
    return F.regexp_replace(text.plain_path(path), "/[^/]*$", "")


def _files(spark: SparkSession, root: str | DataFrame, name: str) -> DataFrame:
    if isinstance(root, DataFrame):
        return root.where(F.substring_index("path", "/", -1) == name)
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", name)
        .load(root)
    )


def read_commits(spark: SparkSession, root: str | DataFrame) -> DataFrame:
    """One row per commit marker below ``root``: folder, its numbers, and what is wrong with it."""
    content = F.col("content")
    wrong = (
        F.when(F.length(content) != schemas.COMMIT_BYTES, "invalid_size")
        .when(
            (F.hex(F.substring(content, 1, 4)) != schemas.COMMIT_MAGIC)
            | (_number(content, 4, 4) != schemas.COMMIT_VERSION),
            "invalid_header",
        )
        .when(
            F.crc32(F.substring(content, 1, schemas.COMMIT_BYTES - 4))
            != _number(content, schemas.COMMIT_BYTES - 4, 4),
            "invalid_checksum",
        )
    )
    files = _files(spark, root, "archive_commit.bin")
    checked = files.select(_folder(F.col("path")).alias("folder"), "content", wrong.alias("error"))
    numbers = [
        F.when(F.col("error").isNull(), _number(content, at, 8)).alias(name)
        for name, at in schemas.COMMIT_FIELDS.items()
    ]
    return checked.select("folder", "error", *numbers)


def committed_lines(
    spark: SparkSession,
    root: str | DataFrame,
    name: str,
    schema: str,
    size: str,
) -> tuple[DataFrame, DataFrame]:
    """Rows of the JSON-lines file ``name`` of all sessions below ``root``, and errors.

    ``size`` is the commit's column with the file's safe bytes. Errors have
    folder and error: a marker that fails its check, a file that is too short or
    missing, or a line inside the safe bytes that is no JSON object. Instead of
    a folder, ``root`` may be the files packed as rows: path, start (0), length
    and content.
    """
    commits = read_commits(spark, root)
    lengths = _files(spark, root, name).select(_folder(F.col("path")).alias("folder"), "length")
    sized = commits.join(lengths, "folder", "left").withColumn(
        "error",
        F.coalesce(
            "error", F.when(F.coalesce("length", F.lit(0)) < F.col(size), F.lit("shorter_than_commit"))
        ),
    )
    if isinstance(root, DataFrame):
        lines = text.packed_lines(spark, _files(spark, root, name))
    else:
        lines = text.lines_with_places(spark, root, recursiveFileLookup=True, pathGlobFilter=name)
    lines = lines.withColumn("folder", _folder(F.col("source_file")))
    safe = lines.join(sized.where("error IS NULL").select("folder", F.col(size).alias("_safe")), "folder")
    line = text.without_return(F.col("value"))
    started = safe.where(F.col("start_byte") < F.col("_safe")).where(F.trim(line) != "")
    whole = F.col("start_byte") + F.octet_length("value") <= F.col("_safe")
    parsed = started.withColumn("_row", F.when(whole, text.parsed_line(F.col("value"), schema)))
    rows = parsed.where(F.col("_row").isNotNull()).select("folder", "_row.*")
    torn = parsed.where(F.col("_row").isNull()).select("folder", F.lit("malformed_json").alias("error"))
    return rows, sized.where("error IS NOT NULL").select("folder", "error").union(torn)
