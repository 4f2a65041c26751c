"""Aggregates over streams: integrity, summaries, normalisers, error metrics, calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import ordered, session
from braidline.functions import gripper
from braidline.operators.clocks import UINT32

# Limits of the sensors' checks.
SEQUENCE_GAP_LIMIT = 1_000_000
DEPTH_BAND_M = 0.008
SWEEP_MIN_SAMPLES = 20
SWEEP_MIN_RANGE_PX = 80.0
SWEEP_MIN_PATH_PX = 60.0
CYCLE_MIN_RANGE_PX = 12.0
CYCLE_LOW, CYCLE_HIGH = 0.28, 0.72
ZERO_FORCE_LIMIT_N = 0.15
STABLE_MEAN_DELTA, STABLE_NOISE_STD = 8.0, 20.0
SPLIT_SHARES = {"train": 0.64, "val": 0.16, "test": 0.20}


def status_histogram(rows: DataFrame, keys: list[str], status: str) -> DataFrame:
    """Rows per status, null counted as unknown. (A3)"""
    named = F.coalesce(F.col(status), F.lit("unknown")).alias("status")
    return rows.groupBy(*keys, named).agg(F.count(F.lit(1)).alias("n"))


def frame_integrity(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    sides: dict[str, str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Missing and out-of-order frame numbers per source and side, in file order. (A4)

    Apply it to whole files, before any window is cut. ``sides`` maps a name to
    its frame number column; missing_frames and out_of_order_frames take the
    worse side.
    """
    specs = {f"_p_{s}": ordered.Fill(c, strict=True) for s, c in sides.items()}
    step = ordered.scan(rows, keys, order, rows_per_task, **specs)
    at, aggs = F.struct(*order), []
    for s, c in sides.items():
        v, p = F.col(c), F.col(f"_p_{s}")
        known = F.when(v.isNotNull(), at)
        aggs += [
            F.coalesce(F.sum(F.when(v > p + 1, v - p - 1)), F.lit(0)).alias(f"{s}_missing"),
            F.count_if(v <= p).alias(f"{s}_out_of_order"),
            F.min_by(v, known).alias(f"{s}_first"),
            F.max_by(v, known).alias(f"{s}_last"),
        ]
    worst = {
        kind: F.greatest(*[F.col(f"{s}_{kind}") for s in sides])
        if len(sides) > 1
        else F.col(f"{next(iter(sides))}_{kind}")
        for kind in ("missing", "out_of_order")
    }
    return (
        step.groupBy(*keys)
        .agg(*aggs)
        .withColumn("missing_frames", worst["missing"])
        .withColumn("out_of_order_frames", worst["out_of_order"])
    )


def integrity_total(per_source: DataFrame, keys: list[str]) -> DataFrame:
    """Worse-side counts summed over the sources of a stream. (A4)"""
    return (
        per_source.groupBy(*keys)
        .agg(
            F.sum("missing_frames").alias("missing_frames"),
            F.sum("out_of_order_frames").alias("out_of_order_frames"),
        )
        .withColumn("ok", (F.col("missing_frames") == 0) & (F.col("out_of_order_frames") == 0))
    )


def sequence_gap(previous: Column, current: Column) -> tuple[Column, Column]:
    """(dropped, out of order) between neighbours of a uint32 sequence. (A5)"""
    gap = F.pmod(current - previous - 1, F.lit(UINT32))
    near = gap < SEQUENCE_GAP_LIMIT
    return (
        F.coalesce(F.when(near, gap), F.lit(0).cast("long")),
        F.coalesce(~near, F.lit(False)),
    )


def sequence_gaps(
    packets: DataFrame,
    keys: list[str],
    order: list[str],
    sequence: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Dropped and out-of-order packets per source; every packet becomes the new reference. (A5)"""
    step = ordered.scan(packets, keys, order, rows_per_task, _prev=ordered.Lag(sequence))
    dropped, late = sequence_gap(F.col("_prev"), F.col(sequence))
    return step.groupBy(*keys).agg(
        F.sum(dropped).alias("dropped"), F.count_if(late).alias("out_of_order")
    )


def stream_summary(
    frames: DataFrame,
    keys: list[str],
    order: list[str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Counts, rate, opening range and ages of a received stream.

    Columns: sequence, t, pose_valid, gripper_valid, rgb_valid, open_percent,
    gripper_age_ms, tracking. Any step other than one counts at least one drop.
    """
    step = ordered.scan(
        frames, keys, order, rows_per_task, _prev=ordered.Fill("sequence", strict=True)
    )
    jump = F.col("sequence") - F.col("_prev")
    lost = F.when(jump != 1, F.greatest(F.lit(1).cast("long"), jump - 1))
    at = F.when(F.col("t").isNotNull(), F.struct(*order))
    seconds = F.greatest(
        F.lit(0.0), (F.max_by("t", at) - F.min_by("t", at)) / 1e9
    )
    return step.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        *[F.count_if(c).alias(c) for c in ("pose_valid", "gripper_valid", "rgb_valid")],
        F.coalesce(F.sum(lost), F.lit(0)).alias("dropped"),
        (F.count(F.lit(1)) / F.nullif(seconds, F.lit(0.0))).alias("capture_fps"),
        F.min("open_percent").alias("open_min"),
        F.max("open_percent").alias("open_max"),
        F.min("gripper_age_ms").alias("age_min_ms"),
        F.avg("gripper_age_ms").alias("age_mean_ms"),
        F.max("gripper_age_ms").alias("age_max_ms"),
        # a set over an enum: at most one entry per state
        F.concat_ws(",", F.sort_array(F.collect_set("tracking"))).alias("tracking_states"),
    )


def minmax(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Normaliser per dimension: a close range becomes 1 wide, no rows give 0 and 1."""
    grouped = rows.groupBy(*keys)
    low_high = grouped.agg(
        *[F.min(c).alias(f"_lo_{c}") for c in columns],
        *[F.max(c).alias(f"_hi_{c}") for c in columns],
    )
    out = []
    for c in columns:
        lo = F.coalesce(f"_lo_{c}", F.lit(0.0))
        hi = F.coalesce(f"_hi_{c}", F.lit(1.0))
        close = F.abs(hi - lo) <= 1e-8 + 1e-5 * F.abs(lo)
        out += [lo.alias(f"{c}_min"), F.when(close, lo + 1.0).otherwise(hi).alias(f"{c}_max")]
    return low_high.select(*keys, *out)


def zscore_constants(rows: DataFrame, split: str, columns: list[str], train: str = "train"):
    """Mean and population deviation of the training rows; a zero deviation becomes one."""
    stats = rows.where(F.col(split) == train).agg(
        *[F.avg(c).alias(f"{c}_mu") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}_sd") for c in columns],
    )
    return stats.select(
        *[f"{c}_mu" for c in columns],
        *[
            F.when(F.col(f"{c}_sd") == 0, 1.0).otherwise(F.col(f"{c}_sd")).alias(f"{c}_sd")
            for c in columns
        ],
    )


def zscored(rows: DataFrame, split: str, columns: list[str], train: str = "train") -> DataFrame:
    """Rows of all splits normalised by the training constants."""
    stats = zscore_constants(rows, split, columns, train)
    packed = stats.select(F.struct("*").alias("s")).scalar()
    staged = rows.withColumn("_s", packed)
    return staged.select(
        *rows.columns,
        *[
            ((F.col(c) - F.col(f"_s.{c}_mu")) / F.col(f"_s.{c}_sd")).alias(f"{c}_z")
            for c in columns
        ],
    )


def split_from_name(name: Column) -> Column:
    """train, val or test from a file name's suffix; null otherwise. (A10)"""
    found = F.regexp_extract(name, r"_(train|val|test)\.h5", 1)
    return F.nullif(found, F.lit(""))


def error_metrics(
    rows: DataFrame, keys: list[str], truth: str, predicted: str
) -> DataFrame:
    """MSE, RMSE and R2 per group."""
    error = F.col(truth) - F.col(predicted)
    return rows.groupBy(*keys).agg(
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (1 - F.avg(error * error) / F.nullif(F.var_pop(truth), F.lit(0.0))).alias("r2"),
    )


FACTOR = "factor array<double>, n long"


def _triangle(factor: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """R factor of what came before and some more rows: the same normal equations, in few rows."""
    return np.linalg.qr(rows if factor is None else np.vstack([factor, rows]), mode="r")


def _factors(keys: list[str], channels: str, target: str, width: int):
    """One R factor of [features, target] for each key of a task; incomplete rows are left out."""
    most = 4096  # keys that a task holds at once

    def matrix(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        nulls = pc.list_parent_indices(column).filter(pc.list_flatten(column).is_null())
        whole = sizes == sizes.max(initial=0)
        whole[nulls.to_numpy()] = False
        usable = column.filter(pa.array(whole))
        flat = usable.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        out = np.zeros((len(column), int(sizes.max(initial=0))))
        out[whole] = flat.reshape(-1, out.shape[1]) if out.shape[1] else 0.0
        return out, whole

    def found(held: dict, kinds: list) -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
        columns.append(pa.array([r.ravel() for r, _ in held.values()], pa.list_(pa.float64())))
        columns.append(pa.array([n for _, n in held.values()], pa.int64()))
        return pa.RecordBatch.from_arrays(columns, [*keys, "factor", "n"])

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        kinds: list = []
        for batch in batches:
            kinds = [batch.column(k).type for k in keys]
            (x, x_whole), (y, y_whole) = matrix(batch.column(channels)), matrix(batch.column(target))
            if x.shape[1] * 2 + y.shape[1] != width:
                continue  # no usable row
            full = np.hstack([x, x * x, y])
            usable = x_whole & y_whole & np.isfinite(full).all(axis=1)
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*[batch.column(k).to_pylist() for k in keys])):
                if usable[i]:
                    places.setdefault(key, []).append(i)
            for key, at in places.items():
                before, n = held.get(key, (None, 0))
                held[key] = _triangle(before, full[at]), n + len(at)
            if len(held) > most:
                yield found(held, kinds)
                held = {}
        if held:
            yield found(held, kinds)

    return factor


def quadratic_fit(rows: DataFrame, keys: list[str], channels: str, target: str) -> DataFrame:
    """Least squares of ``target`` on channels and their squares for each key, no intercept.

    Returns keys, ``coefficients`` (features x axes) and the number of rows
    used. Tasks reduce their rows of a key to an R factor, and R factors are
    merged like rows, so a group never holds more than two of them; a key with
    most of the rows is one small factor from each task.
    """
    session.ship_package(rows.sparkSession)
    sizes = rows.agg(F.max(F.size(channels)), F.max(F.size(target))).first()
    n, m = 2 * max(sizes[0] or 0, 0), max(sizes[1] or 0, 0)
    named = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    parts = rows.select(*keys, channels, target).mapInArrow(
        _factors(keys, channels, target, n + m), f"{named}, {FACTOR}"
    )

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, used, first = None, 0, None
        for batch in batches:
            first = batch if first is None else first
            for part, count in zip(batch.column("factor").to_pylist(), batch.column("n").to_pylist()):
                whole = _triangle(whole, np.array(part).reshape(-1, n + m))
                used += count
        left, right = whole[:, :n], whole[:, n:]
        # columns of one length keep the small system well conditioned
        scale = np.sqrt(np.maximum((left**2).sum(axis=0), 1e-300))
        solution, *_ = np.linalg.lstsq(left / scale, right, rcond=None)
        columns = [first.column(k).slice(0, 1) for k in keys]
        columns.append(pa.array([(solution / scale[:, None]).tolist()], pa.list_(pa.list_(pa.float64()))))
        columns.append(pa.array([used], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, [*keys, "coefficients", "rows_used"])

    return parts.groupBy(*keys).applyInArrow(
        solve, f"{named}, coefficients array<array<double>>, rows_used long"
    )


def quadratic_features(channels: Column) -> Column:
    """Channels and their squares."""
    return F.concat(channels, F.transform(channels, lambda x: x * x))


def quadratic_apply(channels: Column, coefficients: Column) -> Column:
    """Predicted axes for a channel array, with the coefficients of its key."""
    features = quadratic_features(channels)
    axes = F.sequence(F.lit(0), F.size(F.get(coefficients, F.lit(0))) - 1)
    return F.transform(
        axes,
        lambda a: F.aggregate(
            F.zip_with(features, coefficients, lambda x, c: x * F.get(c, a)), F.lit(0.0), lambda s, v: s + v
        ),
    )


def tare_offsets(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    channels: list[str],
    first: int,
    last: int,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Channel means over rows [first, last) of each source, or why there are none."""
    ranked = ordered.scan(rows, keys, order, rows_per_task, _n=ordered.RowNumber())
    used = F.col("_n").between(first + 1, last)
    enough = F.max("_n") >= last
    return ranked.groupBy(*keys).agg(
        *[
            F.when(enough, F.avg(F.when(used, F.col(c)))).alias(f"{c}_offset") for c in channels
        ],
        F.when(enough, F.lit("ok")).otherwise(F.lit("too_few_samples")).alias("status"),
    )


def first_row_baseline(rows: DataFrame, order: list[str], columns: list[str]) -> DataFrame:
    """Columns minus their value in the first row of the whole export."""
    first = rows.agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("b")).scalar()
    staged = rows.withColumn("_b", first)
    return staged.select(
        *[(F.col(c) - F.col(f"_b.{c}")).alias(c) if c in columns else c for c in rows.columns]
    )


def opening_scores(rows: DataFrame, keys: list[str], width: str) -> DataFrame:
    """Widths as 0..100 of their range; fewer than two or no range give 0, null stays null."""
    stats = rows.groupBy(*keys).agg(
        F.count(width).alias("_n"), F.min(width).alias("_lo"), F.max(width).alias("_hi")
    )
    flat = (F.col("_n") < 2) | (F.col("_hi") - F.col("_lo") < 1e-9)
    # the guarded divisor keeps a flat range from dividing by zero
    share = (F.col(width) - F.col("_lo")) / F.when(~flat, F.col("_hi") - F.col("_lo")) * 100.0
    score = F.when(flat, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), share)))
    return rows.join(stats, keys).select(
        *rows.columns, F.when(F.col(width).isNotNull(), score).alias("score")
    )


def banded_marker_width(
    rows: DataFrame,
    keys: list[str],
    visible_z: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Width from the markers near the median depth.

    Columns left_x, left_z, right_x, right_z; a marker counts when it is less
    than 8 mm from the median of ``visible_z``, or when there is no median.
    """
    middle = ordered.percentiles(rows, keys, visible_z, rows_per_task, nominal_z=0.5)
    joined = rows.join(middle, keys, "left") if keys else rows.withColumn(
        "nominal_z", middle.scalar()
    )

    def seen(side: str) -> Column:
        z, x = F.col(f"{side}_z"), F.col(f"{side}_x")
        near = (z > F.col("nominal_z") - DEPTH_BAND_M) & (z < F.col("nominal_z") + DEPTH_BAND_M)
        return F.when(F.col("nominal_z").isNull() | near, x)

    return joined.withColumn("width", gripper.marker_width(seen("left"), seen("right")))


def sweep_calibration(
    rows: DataFrame,
    keys: list[str],
    distance: str,
    seq: str,
    points: list[str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Closed and open ends of a calibration sweep.

    Averages ``points`` over the closest and the farthest samples. Keys with
    too few samples or too little travel say so in ``status``.
    """
    known = rows.where(F.col(distance).isNotNull())
    ranked = ordered.scan(
        known, keys, [distance, seq], rows_per_task,
        _k=ordered.RowNumber(), _n=ordered.Total("count", distance),
    )
    n = F.col("_n")
    bucket = F.least(
        F.greatest(F.lit(10).cast("long"), ordered.floor_div(n, 6)),
        F.greatest(F.lit(10).cast("long"), ordered.floor_div(n, 3)),
    )
    low, high = F.col("_k") <= bucket, F.col("_k") > n - bucket
    ends = []
    for c in [distance, *points]:
        ends += [
            F.avg(F.when(low, F.col(c))).alias(f"closed_{c}"),
            F.avg(F.when(high, F.col(c))).alias(f"open_{c}"),
        ]
    travel = F.max(distance) - F.min(distance)
    return ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"),
        travel.alias("travel"),
        F.when(F.count(F.lit(1)) < SWEEP_MIN_SAMPLES, F.lit("too_few_samples"))
        .when(travel < SWEEP_MIN_RANGE_PX, F.lit("range_too_small"))
        .otherwise(F.lit("ok"))
        .alias("status"),
        *ends,
    )


def usable_path(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Whether the two ends of a marker's path are far enough apart."""
    return F.hypot(bx - ax, by - ay) >= SWEEP_MIN_PATH_PX


def sweep_cycles(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    distance: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Open-close cycles: changes between the low and the high zone, halved."""
    stats = rows.groupBy(*keys).agg(F.min(distance).alias("_lo"), F.max(distance).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    zone = F.when(F.col(distance) <= F.col("_lo") + span * CYCLE_LOW, -1).when(
        F.col(distance) >= F.col("_lo") + span * CYCLE_HIGH, 1
    )
    placed = (
        rows.join(stats, keys)
        .withColumn("_zone", F.when(span >= CYCLE_MIN_RANGE_PX, zone))
        .where(F.col("_zone").isNotNull())
    )
    step = ordered.scan(placed, keys, order, rows_per_task, _prev=ordered.Lag("_zone"))
    turns = step.groupBy(*keys).agg(
        (F.count_if(F.col("_zone") != F.col("_prev")) / 2.0).alias("_cycles")
    )
    return stats.join(turns, keys, "left").select(
        *keys, F.coalesce("_cycles", F.lit(0.0)).alias("cycles")
    )


def age_summary(
    rows: DataFrame, keys: list[str], age: str, rows_per_task: int | None = None
) -> DataFrame:
    """Largest and 95th percentile of absolute ages."""
    absolute = rows.select(*keys, F.abs(age).alias("_a"))
    return ordered.percentiles(absolute, keys, "_a", rows_per_task, age_max=1.0, age_p95=0.95)


def field_differences(
    stored: DataFrame, current: DataFrame, key: list[str], fields: list[str]
) -> DataFrame:
    """Contract fields that both sides state and disagree about."""

    def tall(df: DataFrame, name: str) -> DataFrame:
        return df.select(*key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(
            key, fields, "field", name
        )

    both = tall(stored, "expected").join(tall(current, "actual"), [*key, "field"])
    return both.where(F.col("expected") != F.col("actual"))


def raw_stability(
    rows: DataFrame, keys: list[str], time: str, end: Column, window: int, channels: str
) -> DataFrame:
    """How much channel means moved between two adjacent windows, and their noise.

    ``end`` is the time of the check. The noise is the median of the channels'
    deviations, over one row per channel.
    """
    t = F.col(time)
    now = (t >= end - window) & (t <= end)
    before = (t >= end - 2 * window) & (t <= end - window)
    tall = rows.where(now | before).select(
        *keys, now.alias("_now"), before.alias("_before"),
        F.posexplode(channels).alias("_channel", "_v"),
    )
    per_channel = tall.groupBy(*keys, "_channel").agg(
        F.avg(F.when(F.col("_now"), F.col("_v"))).alias("_m1"),
        F.avg(F.when(F.col("_before"), F.col("_v"))).alias("_m0"),
        F.stddev_pop(F.when(F.col("_now"), F.col("_v"))).alias("_sd"),
    )
    return (
        per_channel.groupBy(*keys)
        .agg(
            F.max(F.abs(F.col("_m1") - F.col("_m0"))).alias("mean_delta"),
            F.percentile("_sd", F.lit(0.5)).alias("noise_std"),
        )
        .withColumn(
            "stable",
            F.coalesce(
                (F.col("mean_delta") <= STABLE_MEAN_DELTA)
                & (F.col("noise_std") <= STABLE_NOISE_STD),
                F.lit(False),
            ),
        )
    )


def zero_check(
    rows: DataFrame, keys: list[str], forces: list[str], limit: float = ZERO_FORCE_LIMIT_N
) -> DataFrame:
    """Largest mean force of an unloaded sensor and whether it passes."""
    worst = F.greatest(*[F.abs(F.avg(c)) for c in forces])
    return (
        rows.groupBy(*keys)
        .agg(worst.alias("max_abs_force"))
        .withColumn("ok", F.coalesce(F.col("max_abs_force") <= limit, F.lit(False)))
    )


def buffer_stats(
    rows: DataFrame, keys: list[str], time: str, max_age: int, max_items: int,
    rows_per_task: int | None = None,
) -> DataFrame:
    """What a buffer bounded by age and count holds after all rows arrived."""
    order = [time]
    ranked = ordered.scan(
        rows.select(*keys, time), keys, order, rows_per_task,
        _k=ordered.RowNumber(), _n=ordered.Total("count", time), _last=ordered.Total("max", time),
    )
    kept = (F.col(time) >= F.col("_last") - max_age) & (F.col("_k") > F.col("_n") - max_items)
    t = F.when(kept, F.col(time))
    return ranked.groupBy(*keys).agg(
        F.count(t).alias("count"),
        ((F.max(t) - F.min(t)) / 1e9).alias("span_s"),
        F.min(t).alias("first_ns"),
        F.max(t).alias("latest_ns"),
        F.count(F.lit(1)).alias("appended"),
        (F.count(F.lit(1)) - F.count(t)).alias("pruned"),
    )


def seeded_split(key: Column, seed: int, shares: dict[str, float] | None = None) -> Column:
    """Split of a row by a hash of its key: the same on every run and every machine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    point = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    names, edge, out = list((shares or SPLIT_SHARES).items()), 0.0, None
    for name, share in names[:-1]:
        edge += share
        below = point < F.lit(edge)
        out = F.when(below, F.lit(name)) if out is None else out.when(below, F.lit(name))
    return out.otherwise(F.lit(names[-1][0]))


def max_abs_force(left: Column, right: Column) -> Column:
    """Largest |Fx|, |Fy|, |Fz| of both sides, null unless both are calibrated."""

    def side(w: Column) -> Column:
        return F.array_max(F.transform(F.slice(w, 1, 3), lambda x: F.abs(x)))

    both = left.isNotNull() & right.isNotNull()
    return F.when(both, F.greatest(side(left), side(right), F.lit(0.0)))


def trailing_max_force(
    rows: DataFrame,
    keys: list[str],
    time: str,
    force: str,
    window: int,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Largest force over the last ``window`` of time."""
    return ordered.time_window(rows, keys, time, window, 0, rows_per_task, recent_max=("max", force))


def array_lengths(lengths: DataFrame, keys: list[str], length: str) -> DataFrame:
    """Whether the arrays of an episode have one length.

    Distinct lengths are reduced before they are listed.
    """
    distinct = lengths.where(F.col(length).isNotNull()).select(*keys, length).distinct()
    listed = distinct.groupBy(*keys).agg(F.sort_array(F.collect_list(length)).alias("_l"))
    every = lengths.select(*keys).distinct().join(listed, keys, "left")
    return every.select(
        *keys,
        F.when(F.col("_l").isNull(), F.lit("unknown"))
        .when(F.size("_l") > 1, F.lit("review"))
        .otherwise(F.lit("ok"))
        .alias("status"),
        F.coalesce(F.array_join("_l", ","), F.lit("")).alias("lengths"),
    )


def demo_checks(demos: DataFrame, key: str) -> DataFrame:
    """Validate demos held as column arrays.

    Columns: pose_times array<double>, pose_transforms array<array<array>>,
    frame_times, depth_times, widths (the last two may be null).
    """
    n = F.size("pose_times")
    growing = F.forall(
        F.zip_with(
            F.slice("pose_times", F.lit(1), F.greatest(n - 1, F.lit(0))),
            F.slice("pose_times", F.lit(2), F.greatest(n - 1, F.lit(0))),
            lambda a, b: b > a,
        ),
        lambda ok: ok,
    )
    square = F.forall(
        "pose_transforms",
        lambda m: (F.size(m) == 4) & F.forall(m, lambda row: F.size(row) == 4),
    )
    span = F.element_at("pose_times", -1) - F.element_at("pose_times", 1)

    def rule(bad: Column, name: str) -> Column:
        return F.when(bad, F.lit(name))

    errors = F.array_compact(
        F.array(
            rule(n == 0, "empty"),
            rule(F.size("pose_transforms") != n, "transform_count"),
            rule(F.size("frame_times") != n, "frame_count"),
            rule(F.col("widths").isNotNull() & (F.size("widths") != n), "width_count"),
            rule(~growing, "not_increasing"),
            rule(~square, "transform_shape"),
        )
    )
    warning = F.coalesce((F.size("depth_times") > 0) & (F.size("depth_times") != n), F.lit(False))
    usable = (n > 1) & growing
    return demos.select(
        key,
        (F.size(errors) == 0).alias("ok"),
        F.array_join(errors, ",").alias("errors"),
        warning.alias("depth_count_differs"),
        F.when(usable, span).alias("duration_s"),
        F.when(usable, (n - 1) / span).alias("fps"),
    )
