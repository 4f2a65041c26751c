"""Action labels, smoothing, holding and fusion along an episode."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidline import ordered, session
from braidline.functions import se3

# Hold times and confidence rules of the marker tracker.
MARKER_HOLD_S = 0.70
OPENING_HOLD_S = 0.80
DECAY, DECAY_STEP = 0.94, 0.015
AGREEMENT_PERCENT = 30.0
SINGLE_MARKER_AGREEMENT = 0.62
AREA_SCALE, MIN_AREA_SCORE, MIN_WEIGHT = 900.0, 0.25, 0.001
SOURCE_SCORES = {"detected": 1.0, "path_candidate": 0.45, "held": 0.20, "rejected": 0.0}


def pose_actions(
    rows: DataFrame,
    episode: list[str],
    order: list[str],
    pose: str,
    dims: int = 6,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add ``action``: next pose minus pose inside the episode, zero at its end."""
    step = ordered.scan(rows, episode, order, rows_per_task, _next=ordered.Lead(pose))
    delta = F.zip_with("_next", pose, lambda a, b: a - b)
    zero = F.array(*[F.lit(0.0)] * dims)
    return step.withColumn("action", F.coalesce(delta, zero)).drop("_next")


def gripper_actions(
    rows: DataFrame,
    episode: list[str],
    order: list[str],
    state: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add ``gripper_action``: the next state, repeated at the end of the episode."""
    step = ordered.scan(rows, episode, order, rows_per_task, _next=ordered.Lead(state))
    return step.withColumn("gripper_action", F.coalesce("_next", state)).drop("_next")


def export_actions(
    rows: DataFrame, order: list[str], columns: list[str], rows_per_task: int | None = None
) -> DataFrame:
    """Deltas over the whole export: they cross episodes, the last row repeats the one before."""
    specs = {f"_n_{c}": ordered.Lead(c) for c in columns}
    specs |= {f"_p_{c}": ordered.Lag(c) for c in columns}
    step = ordered.scan(rows, [], order, rows_per_task, **specs)
    deltas = [
        F.coalesce(
            F.col(f"_n_{c}") - F.col(c), F.col(c) - F.col(f"_p_{c}"), F.lit(0.0)
        ).alias(f"action_{c}")
        for c in columns
    ]
    return step.select(*rows.columns, *deltas)


def moving_average(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    window: int = 5,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Mean of the last ``window`` rows; put the tare epoch into ``keys`` to restart there."""
    return ordered.trailing_rows(
        rows, keys, order, window, rows_per_task,
        **{f"{c}_avg": ("avg", c) for c in columns},
    )


def tare_progress(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    channels: list[str],
    target: int = 300,
    ignored: int = 10,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Number the rows of each sensor and subtract its tare once enough arrived.

    The row that completes the tare is already calibrated. The first
    ``ignored`` rows do not count unless that would leave none.
    """
    target = max(1, target)
    skip = max(0, ignored) if max(0, ignored) < target else 0
    ranked = ordered.scan(rows, keys, order, rows_per_task, _n=ordered.RowNumber())
    used = (F.col("_n") > skip) & (F.col("_n") <= target)
    offsets = ranked.where(used).groupBy(*keys).agg(
        *[F.avg(c).alias(f"_o_{c}") for c in channels]
    )
    ready = F.col("_n") >= target
    joined = ranked.join(offsets, keys, "left")
    return joined.select(
        *rows.columns,
        F.when(ready, F.lit("ok")).otherwise(F.lit("tare_pending")).alias("calibration_status"),
        F.least(F.col("_n"), F.lit(target).cast("long")).alias("tare_count"),
        *[F.when(ready, F.col(c) - F.col(f"_o_{c}")).alias(f"{c}_zeroed") for c in channels],
    )


def _appended(batch: pa.RecordBatch, **columns: list) -> pa.RecordBatch:
    """The batch as it came, with columns of doubles added."""
    for name, values in columns.items():
        batch = batch.append_column(name, pa.array(values, pa.float64()))
    return batch


def _smooth_pieces(
    batches: Iterator[pa.RecordBatch], names: list[str], value: str, alpha: float
) -> Iterator[pa.RecordBatch]:
    """Smooth each (key, piece) run of sorted rows, holding one level between batches.

    Emits the level if nothing came before the piece (its first value seeds it),
    and for the other case the level from a start at zero and the weight that
    the level before the piece still has.
    """
    here, level, from_zero, weight = None, None, 0.0, 1.0
    for batch in batches:
        levels, opens, weights = [], [], []
        runs = zip(*[batch.column(n).to_pylist() for n in names])
        for run, x in zip(runs, batch.column(value).cast(pa.float64()).to_pylist()):
            if run != here:
                here, level, from_zero, weight = run, None, 0.0, 1.0
            if x is not None and x == x:
                level = x if level is None else level * (1 - alpha) + x * alpha
                from_zero = from_zero * (1 - alpha) + x * alpha
                weight *= 1 - alpha
            levels.append(level)
            opens.append(from_zero)
            weights.append(weight)
        yield _appended(batch, _level=levels, _open=opens, _weight=weights)


def _carry_levels(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Level at the start of each piece, from the ends of the pieces before it."""
    here, level = None, None
    for batch in batches:
        out = []
        of_keys = zip(*[batch.column(k).to_pylist() for k in keys]) if keys else [()] * len(batch)
        for key, end in zip(of_keys, batch.column("_end").to_pylist()):
            if key != here:
                here, level = key, None
            out.append(level)
            if level is None:
                level = end["_level"]
            else:
                level = end["_open"] + end["_weight"] * level
        yield _appended(batch.drop_columns(["_end"]), _carry=out)


def exponential_smoothing(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    alpha: float,
    name: str = "smoothed",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Exponential smoothing per key; the first value seeds it, nulls keep the level.

    Smoothing is affine in its starting level. Every piece of a large key is
    smoothed by itself, and the level at the end of the piece before it is
    added with the weight it still has.
    """
    session.ship_package(rows.sparkSession)
    pieces = ordered.find_pieces(rows, keys, order, rows_per_task)
    base = ordered.with_piece(rows, keys, order, pieces)
    names = [*keys, ordered.PIECE]
    extra = [T.StructField(c, T.DoubleType()) for c in ("_level", "_open", "_weight")]
    local = (
        base.repartition(*[F.col(n) for n in names])
        .sortWithinPartitions(*names, *order)
        .mapInArrow(
            lambda it: _smooth_pieces(it, names, value, alpha),
            T.StructType([*base.schema.fields, *extra]),
        )
    )
    if pieces.table is None:
        return local.select(*rows.columns, F.col("_level").alias(name))
    # one row per piece of a hot key: bounded by find_pieces
    ends = (
        local.where("_hot")
        .groupBy(*names)
        .agg(F.max_by(F.struct("_level", "_open", "_weight"), F.struct(*order)).alias("_end"))
    )
    carry = (
        ends.repartition(*[F.col(k) for k in keys] or [F.lit(0)])
        .sortWithinPartitions(*names)
        .mapInArrow(
            lambda it: _carry_levels(it, keys),
            T.StructType([*[ends.schema[n] for n in names], T.StructField("_carry", T.DoubleType())]),
        )
        .withColumnsRenamed({n: f"_c_{n}" for n in names})
    )
    joined = local.join(
        F.broadcast(carry), [F.col(n).eqNullSafe(F.col(f"_c_{n}")) for n in names], "left"
    )
    level = F.when(F.col("_carry").isNull(), F.col("_level")).otherwise(
        F.col("_open") + F.col("_weight") * F.col("_carry")
    )
    return joined.select(*rows.columns, level.alias(name))


def held_marker(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    time: str,
    value: str,
    hold: int,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Last known value while it is at most ``hold`` old, its age, and whether it is held."""
    seen = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col(time).alias("t")))
    filled = ordered.scan(rows, keys, order, rows_per_task, _last=ordered.Fill(seen))
    age = F.col(time) - F.col("_last.t")
    return filled.select(
        *rows.columns,
        F.when(age <= hold, F.col("_last.v")).alias("held_value"),
        age.alias("held_age"),
        (F.col(value).isNull() & F.coalesce(age <= hold, F.lit(False))).alias("is_held"),
    )


def decayed_confidence(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    confidence: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Confidence that shrinks with every row without a measurement.

    k steps of ``max(0, c * d - s)`` have a closed form, so only the last
    measurement and its distance in rows are needed.
    """
    pieces = ordered.find_pieces(rows, keys, order, rows_per_task)
    ranked = ordered.scan(rows, keys, order, pieces=pieces, _n=ordered.RowNumber())
    seen = F.when(
        F.col(confidence).isNotNull(), F.struct(F.col(confidence).alias("c"), F.col("_n").alias("n"))
    )
    filled = ordered.scan(ranked, keys, order, pieces=pieces, _last=ordered.Fill(seen))
    shrink = F.pow(F.lit(DECAY), F.col("_n") - F.col("_last.n"))
    lost = (1 - shrink) * (DECAY_STEP / (1 - DECAY))
    value = F.greatest(F.lit(0.0), F.col("_last.c") * shrink - lost)
    return filled.select(*rows.columns, F.coalesce(value, F.lit(0.0)).alias("decayed_confidence"))


def marker_weight(error: Column, limit: Column, area: Column, kind: Column) -> Column:
    """Trust in one marker's estimate."""
    path = F.greatest(F.lit(0.0), 1 - error / limit)
    size = F.least(F.lit(1.0), F.greatest(F.lit(MIN_AREA_SCORE), area / AREA_SCALE))
    scores = F.create_map(*[F.lit(x) for kv in SOURCE_SCORES.items() for x in kv])
    source = F.coalesce(F.try_element_at(scores, kind), F.lit(0.0))
    return F.greatest(F.lit(MIN_WEIGHT), path * size * source)


def fused_opening(
    markers: DataFrame, paths: DataFrame, frame: list[str], marker: str = "marker"
) -> DataFrame:
    """Opening per frame from its markers, weighted, with a confidence.

    ``markers`` have x, y, area, kind and error_limit; ``paths`` ax, ay, bx, by
    per marker. Frames have at most one row per marker.
    """
    p = se3.project_on_segment(*[F.col(c) for c in ("x", "y", "ax", "ay", "bx", "by")])
    seen = (
        markers.join(paths, marker)
        .withColumn("_p", p)
        .where(F.col("_p.length") >= 60.0)
        .withColumn("_percent", F.col("_p.t") * 100.0)
        .withColumn(
            "_w",
            marker_weight(F.col("_p.error"), F.col("error_limit"), F.col("area"), F.col("kind")),
        )
    )
    fused = seen.groupBy(*frame).agg(
        F.count(F.lit(1)).alias("markers"),
        F.sum("_w").alias("_sum"),
        F.sum(F.col("_w") * F.col("_percent")).alias("_wp"),
        (F.max("_percent") - F.min("_percent")).alias("_apart"),
    )
    opening = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("_wp") / F.col("_sum")))
    agreement = F.when(
        F.col("markers") >= 2, F.greatest(F.lit(0.0), 1 - F.col("_apart") / AGREEMENT_PERCENT)
    ).otherwise(F.lit(SINGLE_MARKER_AGREEMENT))
    path = F.least(F.lit(1.0), F.col("_sum") / F.col("markers"))
    return fused.select(
        *frame,
        "markers",
        opening.alias("open_percent"),
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), path * agreement)).alias("confidence"),
    )


def segment_frame_index(
    frames: DataFrame, keys: list[str], order: list[str], rows_per_task: int | None = None
) -> DataFrame:
    """0-based position of a frame in its video segment."""
    ranked = ordered.scan(frames, keys, order, rows_per_task, _n=ordered.RowNumber())
    return ranked.withColumn("segment_frame_index", F.col("_n") - 1).drop("_n")


def step_durations(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    time: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Milliseconds to the next row of the episode."""
    step = ordered.scan(rows, keys, order, rows_per_task, _next=ordered.Lead(time))
    return step.withColumn("dt_ms", (F.col("_next") - F.col(time)) / 1e6).drop("_next")


def strictly_increasing(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    time: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Whether time grows with every row of the key, in row order."""
    step = ordered.scan(rows, keys, order, rows_per_task, _prev=ordered.Lag(time))
    bad = F.count_if(F.col(time) <= F.col("_prev"))
    return step.groupBy(*keys).agg(
        (bad == 0).alias("strictly_increasing"), bad.alias("violations")
    )
