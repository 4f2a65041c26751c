"""Orders, latest items, pages and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidline import ordered


def by_time(
    rows: DataFrame, time: str, seq: str, rows_per_task: int | None = None
) -> DataFrame:
    """Rows with a time, sorted and numbered from 0; equal times keep ``seq`` order. (O1, O2)

    The position makes the order a column, which survives writes and joins.
    """
    timed = rows.where(F.col(time).isNotNull())
    placed = ordered.scan(timed, [], [time, seq], rows_per_task, _n=ordered.RowNumber())
    return placed.withColumn("position", F.col("_n") - 1).drop("_n")


def latest_item(
    items: DataFrame, keys: list[str], recorded: str, modified: str, item: str
) -> DataFrame:
    """Newest item per key by recording time, else by modification time. (O3)"""
    at = F.coalesce(recorded, modified)
    best = F.max_by(F.struct(F.col(item), at.alias("at")), F.struct(at.alias("a"), F.col(item)))
    return items.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def series_page(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    start: int,
    count: int,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Rows ``[start, start + count)`` of every series; the page is what was asked for."""
    ranked = ordered.scan(rows, keys, order, rows_per_task, _n=ordered.RowNumber())
    return (
        ranked.withColumn("sample_index", F.col("_n") - 1)
        .where((F.col("sample_index") >= start) & (F.col("sample_index") < start + count))
        .drop("_n")
    )


def newest_first(
    items: DataFrame, updated: str, seq: str, rows_per_task: int | None = None
) -> DataFrame:
    """Items from the newest on, with their position."""
    back = items.withColumn("_back", -F.col(updated))
    placed = ordered.scan(back, [], ["_back", seq], rows_per_task, _n=ordered.RowNumber())
    return placed.withColumn("position", F.col("_n") - 1).drop("_n", "_back")


def concatenated(sources: list[DataFrame]) -> DataFrame:
    """All rows of several sources of one stream; a missing column is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def distinct_union(sources: list[DataFrame]) -> DataFrame:
    """Every path once, however many sources list it."""
    return reduce(lambda a, b: a.unionByName(b), sources).distinct()
