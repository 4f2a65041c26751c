"""As-of joins: nearest, bracketing and interpolating, on one time axis.

Targets and all their source streams go through one union and one ordered
scan, so a timeline fed by several streams costs a single shuffle. At equal
times a target sorts before the sources. The row *before* is then the last
source strictly earlier, the row *after* the first source at or later than
the target, as a left bisection of a sorted list gives them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import ordered

_T, _KIND, _SEQ = "_t", "_kind", "_seq"


@dataclass(frozen=True)
class Stream:
    """A source stream: rows, their time column, and a column that ranks equal times."""

    df: DataFrame
    time: str
    seq: str


def bracket_join(
    targets: DataFrame,
    streams: dict[str, Stream],
    keys: list[str],
    time: str,
    seq: str,
    rows_per_task: int | None = None,
    after: bool = True,
) -> DataFrame:
    """Add ``<name>_before`` and ``<name>_after`` structs of every stream to the targets.

    Rows without a time are dropped. An exact hit shows up in ``after``; use
    ``bracket`` for the pair in which it fills both sides.
    """
    left = targets.where(F.col(time).isNotNull()).select(
        *keys,
        F.col(time).alias(_T),
        F.lit(0).alias(_KIND),
        F.col(seq).cast("long").alias(_SEQ),
        F.struct(*targets.columns).alias("_target"),
    )
    merged = left
    for name, s in streams.items():
        merged = merged.unionByName(
            s.df.where(F.col(s.time).isNotNull()).select(
                *keys,
                F.col(s.time).alias(_T),
                F.lit(1).alias(_KIND),
                F.col(s.seq).cast("long").alias(_SEQ),
                F.struct(F.col(s.time).alias("_at"), *s.df.columns).alias(f"_s_{name}"),
            ),
            allowMissingColumns=True,
        )
    # rows of two streams may share time and seq: each stream fills a column of its own,
    # so their order among each other does not matter
    specs = {}
    for name in streams:
        specs[f"{name}_before"] = ordered.Fill(f"_s_{name}")
        if after:
            specs[f"{name}_after"] = ordered.FillBack(f"_s_{name}")
    scanned = ordered.scan(merged, keys, [_T, _KIND, _SEQ], rows_per_task, **specs)
    return scanned.where(F.col("_target").isNotNull()).select("_target.*", *specs)


def bracket(name: str, time: str) -> tuple[Column, Column]:
    """(before, after) of a joined stream; an exact hit is both."""
    before, after = F.col(f"{name}_before"), F.col(f"{name}_after")
    exact = after["_at"] == F.col(time)
    return F.when(exact, after).otherwise(before), after


def nearest(name: str, time: str, tie: str = "after") -> Column:
    """The closer of before and after; ``tie`` says which one wins at equal distance."""
    before, after = F.col(f"{name}_before"), F.col(f"{name}_after")
    d_before = F.col(time) - before["_at"]
    d_after = after["_at"] - F.col(time)
    first = d_before <= d_after if tie == "before" else d_before < d_after
    return (
        F.when(before.isNull(), after)
        .when(after.isNull(), before)
        .when(first, before)
        .otherwise(after)
    )


def nearest_join(
    targets: DataFrame,
    sources: Stream,
    keys: list[str],
    time: str,
    seq: str,
    name: str = "near",
    tie: str = "after",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add the nearest source row as struct ``name``, and ``<name>_delta`` = sample - target."""
    both = bracket_join(targets, {name: sources}, keys, time, seq, rows_per_task)
    return (
        both.withColumn(name, nearest(name, time, tie))
        .withColumn(f"{name}_delta", F.col(name)["_at"] - F.col(time))
        .drop(f"{name}_before", f"{name}_after")
    )


def backward_join(
    targets: DataFrame,
    sources: Stream,
    keys: list[str],
    time: str,
    seq: str,
    name: str = "prev",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add the latest source at or before the target as ``name``, and its age."""
    left = targets.where(F.col(time).isNotNull()).select(
        *keys,
        F.col(time).alias(_T),
        F.lit(1).alias(_KIND),
        F.col(seq).cast("long").alias(_SEQ),
        F.struct(*targets.columns).alias("_target"),
    )
    right = sources.df.where(F.col(sources.time).isNotNull()).select(
        *keys,
        F.col(sources.time).alias(_T),
        F.lit(0).alias(_KIND),
        F.col(sources.seq).cast("long").alias(_SEQ),
        F.struct(F.col(sources.time).alias("_at"), *sources.df.columns).alias("_s"),
    )
    merged = left.unionByName(right, allowMissingColumns=True)
    scanned = ordered.scan(
        merged, keys, [_T, _KIND, _SEQ], rows_per_task, **{name: ordered.Fill("_s")}
    )
    return (
        scanned.where(F.col("_target").isNotNull())
        .select("_target.*", name)
        .withColumn(f"{name}_age", F.col(time) - F.col(name)["_at"])
    )


def lerp(a: Column, b: Column, alpha: Column) -> Column:
    return a + (b - a) * alpha


def lerp_vector(a: Column, b: Column, alpha: Column) -> Column:
    """Element-wise interpolation; null when a side is missing, differs in length or holds nulls."""
    usable = (
        (F.size(a) == F.size(b))
        & F.forall(a, lambda x: x.isNotNull())
        & F.forall(b, lambda x: x.isNotNull())
    )
    return F.when(usable, F.zip_with(a, b, lambda x, y: lerp(x, y, alpha)))


def alpha(before: Column, after: Column, time: Column) -> Column:
    """Position of ``time`` between the two rows, 0 when they coincide."""
    span = after["_at"] - before["_at"]
    return F.when(span == 0, F.lit(0.0)).otherwise((time - before["_at"]) / span)


def clamped_interpolation(
    targets: DataFrame,
    sources: Stream,
    keys: list[str],
    time: str,
    seq: str,
    values: list[str],
    name: str = "x",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Linear interpolation of ``values`` at the targets; the end values hold outside the range."""
    needed = dict.fromkeys([*keys, sources.time, sources.seq, *values])
    sources = Stream(sources.df.select(*needed), sources.time, sources.seq)
    both = bracket_join(targets, {name: sources}, keys, time, seq, rows_per_task)
    before, after = bracket(name, time)
    lo, hi = F.coalesce(before, after), F.coalesce(after, before)
    shaped = both.withColumn("_lo", lo).withColumn("_hi", hi)
    at = alpha(F.col("_lo"), F.col("_hi"), F.col(time))
    cols = [lerp(F.col("_lo")[v], F.col("_hi")[v], at).alias(f"{name}_{v}") for v in values]
    return shaped.select(*targets.columns, *cols)


def windows_join(
    samples: DataFrame,
    windows: DataFrame,
    keys: list[str],
    time: str,
    start: str,
    end: str,
    bin_width: int,
) -> DataFrame:
    """Every sample with every window ``[start, end]`` of its key that contains it.

    Windows are spread over the time bins they touch and matched by key and
    bin; the exact bounds are tested after. Windows without a start or with an
    end before the start match nothing.
    """
    left = samples.withColumn("_bin", ordered.floor_div(F.col(time), bin_width))
    right = windows.where(F.col(start) <= F.col(end)).withColumn(
        "_bin",
        F.explode(
            F.sequence(
                ordered.floor_div(F.col(start), bin_width),
                ordered.floor_div(F.col(end), bin_width),
            )
        ),
    )
    return (
        left.join(right, [*keys, "_bin"])
        .where((F.col(time) >= F.col(start)) & (F.col(time) <= F.col(end)))
        .drop("_bin")
    )
