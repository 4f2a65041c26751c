"""Ordered scans inside keys of any size.

A plain window puts every row of a key into one task. ``scan`` does the same
work when one key holds a large share of the data: such keys are cut into
consecutive pieces along their own order, each piece is windowed by itself,
and one summary row per piece carries the state (previous row, running sum,
last non-null value, ...) into the next piece.

The cut points come from a hash sample of (key, order) columns. Their number,
and so the size of the summary table that is broadcast, is bounded by
``spark.braidline.maxTasks``, whatever the data.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidline import session

SAMPLES_PER_TASK = 16
PARTITION_ROWS = 250_000  # rows of all keys that one task orders, as far as there are keys
_BLOCK = 64
_HASH_RANGE = 1 << 30
_KEY = "_key"
PIECE = "_piece"


# ---------------------------------------------------------------------------
# what a scan can compute


@dataclass(frozen=True)
class Lag:
    """Value of the previous row; null on the first row of the key."""

    value: Any


@dataclass(frozen=True)
class Lead:
    """Value of the next row; null on the last row of the key."""

    value: Any


@dataclass(frozen=True)
class RunSum:
    """Sum from the first row of the key up to this row."""

    value: Any


@dataclass(frozen=True)
class RunMax:
    """Maximum from the first row up to this row, or up to the row before it."""

    value: Any
    strict: bool = False


@dataclass(frozen=True)
class RunMin:
    value: Any
    strict: bool = False


@dataclass(frozen=True)
class RowNumber:
    """1-based position of the row in its key."""


@dataclass(frozen=True)
class Fill:
    """Last non-null value at or before this row (before it when strict)."""

    value: Any
    strict: bool = False


@dataclass(frozen=True)
class FillBack:
    """First non-null value at or after this row (after it when strict)."""

    value: Any
    strict: bool = False


@dataclass(frozen=True)
class Total:
    """sum, count, min or max over all rows of the key."""

    how: str
    value: Any


@dataclass
class Pieces:
    """Cut points of the hot keys; ``table`` holds at most ``maxTasks`` points.

    ``rows`` counts the rows of all keys.
    """

    table: DataFrame | None = field(default=None)
    rows: int = 0


def floor_div(x: Column, width: int) -> Column:
    """Exact ``floor(x / width)`` on longs; a plain division would go through double."""
    w = F.lit(width).cast("long")
    return F.call_function("div", x - F.pmod(x, w), w)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def find_pieces(
    df: DataFrame, keys: list[str], order: list[str], rows_per_task: int | None = None
) -> Pieces:
    """Find keys with more than ``rows_per_task`` rows and where to cut them.

    Two narrow jobs: a row count, and (only when some key could be too large)
    a sample of the key and order columns. The sample is chosen by hash, so a
    retried task takes the same rows.
    """
    spark = df.sparkSession
    limit = rows_per_task or session.rows_per_task(spark)
    total = df.count()
    if total <= limit:
        return Pieces(rows=total)
    limit = max(limit, -(-total // session.max_tasks(spark)))
    rate = min(1.0, SAMPLES_PER_TASK / limit)
    step = max(1, int(limit * rate))

    key_cols = [F.col(k) for k in keys] or [F.lit(0).alias(_KEY)]
    names = keys or [_KEY]
    # rows equal in key and order fall into the sample together: count them before
    # anything is gathered, so that a value on half of all rows is one row here
    sampled = (
        df.select(*key_cols, _order_struct(order).alias("_o"))
        .where(
            F.pmod(F.xxhash64(*[F.col(k) for k in keys], "_o"), F.lit(_HASH_RANGE))
            < int(rate * _HASH_RANGE)
        )
        .groupBy(*names, "_o")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # of each key's sample, the places where the running count passes a multiple of step
    upto = F.sum("_n").over(Window.partitionBy(*names).orderBy("_o"))
    passes = F.floor(F.col("_upto") / step) > F.floor((F.col("_upto") - F.col("_n")) / step)
    cuts = sampled.withColumn("_upto", upto).where(passes).select(*names, "_o")
    points_of: dict[tuple, list] = {}
    for row in cuts.collect():
        points_of.setdefault(tuple(row[k] for k in names), []).append(row["_o"])
    if not points_of:
        return Pieces(rows=total)
    blocked = []
    for key, points in points_of.items():
        points.sort(key=lambda p: tuple((v is not None, v) for v in p))
        blocks = [points[i : i + _BLOCK] for i in range(0, len(points), _BLOCK)]
        blocked.append(Row(*key, blocks))
    fields = [cuts.schema[k] for k in names]
    cut_type = T.ArrayType(T.ArrayType(cuts.schema["_o"].dataType))
    schema = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in fields]
        + [T.StructField("_cuts", cut_type, True)]
    )
    return Pieces(spark.createDataFrame(blocked, schema), total)


def whole_if_small(df: DataFrame, rows_per_task: int | None = None) -> Pieces | None:
    """Empty cut points when ``df`` fits one task, so that scans of anything no larger skip
    their own count; None when each scan has to look for itself."""
    limit = rows_per_task or session.rows_per_task(df.sparkSession)
    rows = df.count()
    return Pieces(rows=rows) if rows <= limit else None


def _with_cuts(df: DataFrame, keys: list[str], pieces: Pieces) -> DataFrame:
    """Add the cut points of each row's key, null for keys that are not cut."""
    if not keys:  # one list of cut points for all rows
        return df.withColumn(_KEY, F.lit(0)).withColumn(
            "_cuts", pieces.table.select("_cuts").scalar()
        )
    table = pieces.table.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_cuts")
    same = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]
    return df.join(F.broadcast(table), same, "left").drop(*[f"_h_{k}" for k in keys])


def _piece_of(place: Column) -> Column:
    """Number of cut points below ``place``: first among the blocks, then inside one."""
    return _piece_in(_blocks_below(place), place)


def _blocks_below(place: Column) -> Column:
    return F.when(
        F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", lambda b: b[0] < place))
    ).otherwise(0)


def _piece_in(block: Column, place: Column) -> Column:
    inner = F.size(F.filter(F.element_at("_cuts", block), lambda p: p < place))
    return F.when(block == 0, 0).otherwise((block - 1) * _BLOCK + inner)


def with_piece(df: DataFrame, keys: list[str], order: list[str], pieces: Pieces) -> DataFrame:
    """Number the piece of every row (0 for keys that are not cut) and flag hot keys."""
    if pieces.table is None:
        return df.withColumn(PIECE, F.lit(0)).withColumn("_hot", F.lit(False))
    # place and block are columns of their own, so that each is computed once per row
    placed = (
        _with_cuts(df, keys, pieces)
        .withColumn("_hot", F.col("_cuts").isNotNull())
        .withColumn("_place", F.when(F.col("_hot"), _order_struct(order)))
        .withColumn("_block", _blocks_below(F.col("_place")))
    )
    return placed.withColumn(PIECE, _piece_in(F.col("_block"), F.col("_place"))).drop(
        "_cuts", "_place", "_block"
    )


def dealt(df: DataFrame, part: list[str], rows: int) -> DataFrame:
    """``df`` in partitions whose number follows its rows, if the session's own are too few.

    Windows hold what they sort, so a fixed number would let a task's memory grow with the input.
    """
    spark = df.sparkSession
    tasks = min(-(-rows // PARTITION_ROWS), session.max_tasks(spark))
    if not part or tasks <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return df
    return df.repartition(tasks, *part)


def _frame(w, strict: bool):
    return w.rowsBetween(Window.unboundedPreceding, -1 if strict else 0)


def _local(spec, asc, desc, whole) -> Column:
    """The spec inside one window partition."""
    if isinstance(spec, Lag):
        return F.lag(_col(spec.value)).over(asc)
    if isinstance(spec, Lead):
        return F.lead(_col(spec.value)).over(asc)
    if isinstance(spec, RunSum):
        return F.sum(_col(spec.value)).over(_frame(asc, False))
    if isinstance(spec, RunMax):
        return F.max(_col(spec.value)).over(_frame(asc, spec.strict))
    if isinstance(spec, RunMin):
        return F.min(_col(spec.value)).over(_frame(asc, spec.strict))
    if isinstance(spec, RowNumber):
        return F.row_number().over(asc).cast("long")
    if isinstance(spec, Fill):
        return F.last(_col(spec.value), ignorenulls=True).over(_frame(asc, spec.strict))
    if isinstance(spec, FillBack):
        return F.last(_col(spec.value), ignorenulls=True).over(_frame(desc, spec.strict))
    if isinstance(spec, Total):
        return getattr(F, spec.how)(_col(spec.value)).over(whole)
    raise TypeError(spec)


def _piece_summary(spec, at: Column) -> Column:
    """What one piece contributes to its neighbours."""
    if isinstance(spec, RowNumber):
        return F.count(F.lit(1))
    value = _col(spec.value)
    if isinstance(spec, Lag):
        return F.max_by(F.struct(value.alias("v")), at)
    if isinstance(spec, Lead):
        return F.min_by(F.struct(value.alias("v")), at)
    if isinstance(spec, RunSum):
        return F.sum(value)
    if isinstance(spec, RunMax):
        return F.max(value)
    if isinstance(spec, RunMin):
        return F.min(value)
    if isinstance(spec, Fill):
        return F.max_by(value, F.when(value.isNotNull(), at))
    if isinstance(spec, FillBack):
        return F.min_by(value, F.when(value.isNotNull(), at))
    return getattr(F, spec.how)(value)


def _carry(spec, name: str, asc, desc, whole) -> Column:
    """State that enters a piece from the other pieces of its key."""
    c = F.col(name)
    if isinstance(spec, Lag):
        return F.lag(c).over(asc)["v"]
    if isinstance(spec, Lead):
        return F.lead(c).over(asc)["v"]
    if isinstance(spec, (RunSum, RowNumber)):
        return F.sum(c).over(_frame(asc, True))
    if isinstance(spec, RunMax):
        return F.max(c).over(_frame(asc, True))
    if isinstance(spec, RunMin):
        return F.min(c).over(_frame(asc, True))
    if isinstance(spec, Fill):
        return F.last(c, ignorenulls=True).over(_frame(asc, True))
    if isinstance(spec, FillBack):
        return F.last(c, ignorenulls=True).over(_frame(desc, True))
    return getattr(F, "sum" if spec.how == "count" else spec.how)(c).over(whole)


def _merge(spec, local: Column, carry: Column, hot: Column) -> Column:
    if isinstance(spec, Lag):
        return F.when(F.col("_first"), carry).otherwise(local)
    if isinstance(spec, Lead):
        return F.when(F.col("_last"), carry).otherwise(local)
    if isinstance(spec, (RunSum, RowNumber)):
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local + carry)
    if isinstance(spec, RunMax):
        return F.greatest(local, carry)
    if isinstance(spec, RunMin):
        return F.least(local, carry)
    if isinstance(spec, (Fill, FillBack)):
        return F.coalesce(local, carry)
    return F.when(hot, carry).otherwise(local)


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_task: int | None = None,
    pieces: Pieces | None = None,
    **specs,
) -> DataFrame:
    """Add one column per spec, computed over ``keys`` in ``order``.

    ``order`` must rank the rows of a key uniquely. All specs of one call share
    one shuffle. Values of a spec may use any column of ``df``.
    """
    keys, order = list(keys), list(order)
    pieces = pieces or find_pieces(df, keys, order, rows_per_task)
    if pieces.table is None:
        part = [F.col(k) for k in keys] or [F.lit(0)]
        asc = Window.partitionBy(*part).orderBy(*[F.col(c).asc() for c in order])
        desc = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
        whole = Window.partitionBy(*part)
        return dealt(df, keys, pieces.rows).select(
            "*", *[_local(s, asc, desc, whole).alias(n) for n, s in specs.items()]
        )

    names = keys or [_KEY]
    base = with_piece(df, keys, order, pieces)
    at = _order_struct(order)
    part = [*names, PIECE]
    summary = (
        base.where("_hot")
        .groupBy(*part)
        .agg(*[_piece_summary(s, at).alias(f"_s_{n}") for n, s in specs.items()])
    )
    p_asc = Window.partitionBy(*names).orderBy(F.col(PIECE).asc())
    p_desc = Window.partitionBy(*names).orderBy(F.col(PIECE).desc())
    p_whole = Window.partitionBy(*names)
    carry = summary.select(
        *[F.col(k).alias(f"_c_{k}") for k in part],
        *[_carry(s, f"_s_{n}", p_asc, p_desc, p_whole).alias(f"_c_{n}") for n, s in specs.items()],
    )

    asc = Window.partitionBy(*part).orderBy(*[F.col(c).asc() for c in order])
    desc = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in order])
    whole = Window.partitionBy(*part)
    edges = []
    if any(isinstance(s, Lag) for s in specs.values()):
        edges.append(F.lag(F.lit(True)).over(asc).isNull().alias("_first"))
    if any(isinstance(s, Lead) for s in specs.values()):
        edges.append(F.lead(F.lit(True)).over(asc).isNull().alias("_last"))
    windowed = dealt(base, part, pieces.rows).select(
        "*",
        *edges,
        *[_local(s, asc, desc, whole).alias(f"_l_{n}") for n, s in specs.items()],
    )
    # One carry row per piece of a hot key: bounded by find_pieces.
    joined = windowed.join(
        F.broadcast(carry),
        [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in part],
        "left",
    )
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            _merge(s, F.col(f"_l_{n}"), F.col(f"_c_{n}"), F.col("_hot")).alias(n)
            for n, s in specs.items()
        ],
    )


def trailing_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    k: int,
    rows_per_task: int | None = None,
    **aggs: tuple[str, Any],
) -> DataFrame:
    """Aggregates over the last ``k`` rows (this one included), e.g. ``m=("avg", "x")``.

    Large keys are cut into blocks by row number; the last ``k - 1`` rows of a
    block are copied into the next one.
    """
    keys, order = list(keys), list(order)
    pieces = find_pieces(df, keys, order, rows_per_task)
    part = [F.col(c) for c in keys] or [F.lit(0)]

    def cols(w):
        return [getattr(F, how)(_col(v)).over(w).alias(n) for n, (how, v) in aggs.items()]

    if pieces.table is None:
        w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-(k - 1), 0)
        return df.select("*", *cols(w))
    size = max(rows_per_task or session.rows_per_task(df.sparkSession), k)
    ranked = scan(df, keys, order, pieces=pieces, _rank=RowNumber())
    own = floor_div(F.col("_rank") - 1, size)
    tail = (F.col("_rank") - 1) % size >= size - (k - 1)
    spread = ranked.withColumn(
        "_block", F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    w = Window.partitionBy(*part, "_block").orderBy("_rank").rowsBetween(-(k - 1), 0)
    return (
        spread.select("*", *cols(w))
        .where(F.col("_block") == own)
        .select(*df.columns, *aggs)
    )


def time_window(
    df: DataFrame,
    keys: list[str],
    t: str,
    before: int,
    after: int,
    rows_per_task: int | None = None,
    **aggs: tuple[str, Any],
) -> DataFrame:
    """Aggregates over rows of the key with time in ``[t - before, t + after]``.

    A large key is cut by time; a row is copied into every piece whose rows can
    see it, so that each piece is complete by itself.
    """
    keys = list(keys)
    pieces = find_pieces(df, keys, [t], rows_per_task)
    part = [F.col(c) for c in keys] or [F.lit(0)]

    def cols(w):
        w = w.orderBy(t).rangeBetween(-before, after)
        return [getattr(F, how)(_col(v)).over(w).alias(n) for n, (how, v) in aggs.items()]

    if pieces.table is None:
        return df.select("*", *cols(Window.partitionBy(*part)))

    def at(shift: int) -> Column:
        return F.struct((F.col(t) + F.lit(shift)).cast(df.schema[t].dataType).alias(t))

    spread = _with_cuts(df, keys, pieces).select(
        *df.columns,
        _piece_of(at(0)).alias("_own"),
        F.explode(F.sequence(_piece_of(at(-after)), _piece_of(at(before)))).alias(PIECE),
    )
    return (
        spread.select("*", *cols(Window.partitionBy(*part, PIECE)))
        .where(F.col(PIECE) == F.col("_own"))
        .select(*df.columns, *aggs)
    )


def percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    rows_per_task: int | None = None,
    pieces: Pieces | None = None,
    **fractions: float | str,
) -> DataFrame:
    """Exact percentiles per key with linear interpolation between ranks.

    A fraction of ``"upper_median"`` takes the element at rank ``n div 2``.
    Equal values are counted before the ordered scan, and no group is ever
    held in one aggregation buffer.
    """
    keys, known = list(keys), df.where(F.col(value).isNotNull())
    counted = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    # the scan runs over counted values, so these are what may be too many
    pieces = pieces or find_pieces(counted, keys, [value], rows_per_task)
    ranked = scan(
        counted, keys, [value], pieces=pieces, _upto=RunSum("_n"), _size=Total("sum", "_n")
    )

    def at(rank: Column) -> Column:
        hit = (F.col("_upto") - F.col("_n") <= rank) & (rank < F.col("_upto"))
        return F.max(F.when(hit, F.col(value)))

    parts, out = [], []
    for name, frac in fractions.items():
        if frac == "upper_median":
            parts.append(at(F.floor(F.col("_size") / 2)).alias(f"_{name}"))
            out.append(F.col(f"_{name}").alias(name))
            continue
        pos = (F.col("_size") - 1) * F.lit(float(frac))
        parts += [
            at(F.floor(pos)).alias(f"_{name}_lo"),
            at(F.ceil(pos)).alias(f"_{name}_hi"),
            F.max(pos - F.floor(pos)).alias(f"_{name}_w"),
        ]
        lo, hi, w = (F.col(f"_{name}_{s}") for s in ("lo", "hi", "w"))
        out.append((lo * (1 - w) + hi * w).alias(name))
    grouped = ranked.groupBy(*keys).agg(*parts) if keys else ranked.agg(*parts)
    return grouped.select(*keys, *out)
