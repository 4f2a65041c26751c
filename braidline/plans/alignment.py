"""The aligned timeline: every target frame with all of its streams.

Phone frames are the targets, or ticks of a uniform grid, to which the phone is
then matched like the camera. Both take the nearest sample, the force sensor is
interpolated between its neighbours, and each stream says whether it is usable
and, if not, why. All streams are matched in one ordered scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import asof, ordered

# Widest accepted distances in ms.
FRAME_MAX_MS = 50.0
CAMERA_MAX_MS = 80.0
FORCE_MAX_MS = 25.0


def within(delta_ns: Column, limit_ms: float) -> Column:
    return F.coalesce(F.abs(delta_ns) <= F.lit(limit_ms * 1e6), F.lit(False))


def nearest_payload(
    row: Column, delta_ns: Column, limit_ms: float, pair_valid: Column | None = None
) -> Column:
    """Compact payload of a nearest-matched stream.

    Reasons in order: no stream, color/depth mismatch, too far away. A missing
    pair flag counts as valid.
    """
    paired = F.coalesce(pair_valid, F.lit(True)) if pair_valid is not None else F.lit(True)
    valid = row.isNotNull() & within(delta_ns, limit_ms) & paired
    reason = (
        F.when(row.isNull(), F.lit("missing_stream"))
        .when(~paired, F.lit("rgb_depth_timestamp_mismatch"))
        .when(~valid, F.lit("nearest_sample_outside_threshold"))
    )
    return F.struct(
        valid.alias("valid"),
        F.when(row.isNotNull(), delta_ns / F.lit(1e6)).alias("source_delta_ms"),
        reason.alias("dropped_reason"),
        row.alias("row"),
    )


def interpolated_payload(
    before: Column, after: Column, time: Column, limit_ms: float, vectors: list[str]
) -> Column:
    """Compact payload of a stream interpolated between its neighbours.

    ``vectors`` are array fields of the rows; all of them must be complete. The
    limit applies to the span of the bracket. Identity comes from the nearer
    row, the earlier one at equal distance.
    """
    span = after["_at"] - before["_at"]
    delta_before, delta_after = before["_at"] - time, after["_at"] - time
    near_is_before = -delta_before <= delta_after
    near = F.when(near_is_before, before).otherwise(after)
    delta = F.when(near_is_before, delta_before).otherwise(delta_after)
    at = asof.alpha(before, after, time)
    values = {v: asof.lerp_vector(before[v], after[v], at) for v in vectors}
    complete = F.lit(True)
    for v in values.values():
        complete = complete & v.isNotNull()
    missing = before.isNull() | after.isNull()
    reason = (
        F.when(missing, F.lit("missing_bracketing_samples"))
        .when(
            (delta_before > 0) | (delta_after < 0) | (span < 0),
            F.lit("invalid_bracketing_samples"),
        )
        .when(span > F.lit(limit_ms * 1e6), F.lit("bracketing_gap_outside_threshold"))
        .when(~complete, F.lit("missing_calibrated_wrench"))
    )
    ok = reason.isNull()
    return F.struct(
        ok.alias("valid"),
        F.when(~missing, delta / F.lit(1e6)).alias("source_delta_ms"),
        reason.alias("dropped_reason"),
        F.when(~missing, span / F.lit(1e6)).alias("interpolation_span_ms"),
        F.when(ok, at).alias("alpha"),
        F.when(ok, near).alias("row"),
        *[F.when(ok, value).alias(v) for v, value in values.items()],
    )


def align(
    targets: DataFrame,
    camera: asof.Stream,
    force: asof.Stream,
    keys: list[str],
    time: str,
    seq: str,
    camera_max_ms: float = CAMERA_MAX_MS,
    force_max_ms: float = FORCE_MAX_MS,
    vectors: tuple[str, ...] = ("left_wrench", "right_wrench"),
    pair_valid: str | None = None,
    rows_per_task: int | None = None,
    phone: asof.Stream | None = None,
    phone_max_ms: float = FRAME_MAX_MS,
) -> DataFrame:
    """Targets with ``frame``, ``camera`` and ``force`` payloads.

    Without ``phone`` the targets are frames themselves and always valid; with
    it they are ticks, and ``frame.row`` is the nearest row of the phone.
    """
    streams = {"camera": camera, "force": force} | ({"frame": phone} if phone else {})
    joined = asof.bracket_join(targets, streams, keys, time, seq, rows_per_task)
    near = asof.nearest("camera", time)
    f_before, f_after = asof.bracket("force", time)
    staged = joined.select(
        *targets.columns,
        *([asof.nearest("frame", time).alias("_frame")] if phone else []),
        near.alias("_near"),
        f_before.alias("_before"),
        f_after.alias("_after"),
    )
    t = F.col(time)
    near = F.col("_near")
    if phone:
        frame = nearest_payload(F.col("_frame"), F.col("_frame")["_at"] - t, phone_max_ms)
    else:
        frame = F.struct(
            F.lit(True).alias("valid"),
            F.lit(0.0).alias("source_delta_ms"),
            F.lit(None).cast("string").alias("dropped_reason"),
        )
    shaped = staged.select(
        *targets.columns,
        frame.alias("frame"),
        nearest_payload(
            near,
            near["_at"] - t,
            camera_max_ms,
            near[pair_valid] if pair_valid else None,
        ).alias("camera"),
        interpolated_payload(
            F.col("_before"), F.col("_after"), t, force_max_ms, list(vectors)
        ).alias("force"),
    )
    return shaped.withColumn(
        "all_valid", F.col("frame.valid") & F.col("camera.valid") & F.col("force.valid")
    )


def alignment_counts(timeline: DataFrame, keys: list[str]) -> DataFrame:
    """Row and validity counts per key. (A1)"""
    return timeline.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("timeline_rows"),
        F.count_if("frame.valid").alias("frame_valid"),
        F.count_if("camera.valid").alias("camera_valid"),
        F.count_if("force.valid").alias("force_valid"),
        F.count_if("all_valid").alias("all_valid"),
    )


def source_reuse(timeline: DataFrame, keys: list[str], stream: str, source: str) -> DataFrame:
    """Distinct sources among valid rows, and targets that share one. (A2)"""
    valid = F.col(f"{stream}.valid")
    key = F.when(valid, F.col(source))
    return timeline.groupBy(*keys).agg(
        F.count_distinct(key).alias("unique_sources"),
        (F.count(key) - F.count_distinct(key)).alias("duplicate_targets"),
    )


def sample_index(
    timeline: DataFrame, keys: list[str], order: list[str], rows_per_task: int | None = None
) -> DataFrame:
    """0-based ``sample_index`` inside each key."""
    numbered = ordered.scan(timeline, keys, order, rows_per_task, _n=ordered.RowNumber())
    return numbered.withColumn("sample_index", F.col("_n") - 1).drop("_n")


def global_index(
    timeline: DataFrame, order: list[str], rows_per_task: int | None = None
) -> DataFrame:
    """0-based ``global_sample_index`` over everything."""
    numbered = ordered.scan(timeline, [], order, rows_per_task, _n=ordered.RowNumber())
    return numbered.withColumn("global_sample_index", F.col("_n") - 1).drop("_n")


def uniform_targets(
    episodes: DataFrame, keys: list[str], start: str, end: str, fps: float
) -> DataFrame:
    """Target times at a fixed rate, the end excluded. (E5)"""
    dt = int(round(1_000_000_000 / fps)) if fps > 0 else 0
    if dt <= 0:
        return episodes.select(*keys, F.col(start).alias("t")).where(F.lit(False))
    count = ordered.floor_div(F.col(end) - F.col(start), dt)
    spans = episodes.where((F.col(end) > F.col(start)) & (count > 0)).select(
        *keys, F.col(start).alias("_start"), count.alias("_count")
    )
    # ticks may outnumber the episodes by far: their tasks follow the ticks
    ticks = spans.agg(F.sum("_count")).first()[0] or 0
    return (
        ordered.dealt(spans, keys, ticks)
        .select(
            *keys,
            "_start",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("_count") - 1)).alias("tick"),
        )
        .select(*keys, "tick", (F.col("_start") + F.col("tick") * dt).alias("t"))
    )


def frame_targets(
    episodes: DataFrame,
    primary: DataFrame,
    secondary: DataFrame,
    keys: list[str],
    time: str,
    start: str,
    end: str,
) -> DataFrame:
    """Target frames: the primary stream's, else the secondary's inside the window.

    All primary frames of an episode are targets, whatever their recording flag.
    """
    has_primary = primary.select(*keys).distinct()
    fallback = (
        secondary.join(episodes.select(*keys, start, end), keys)
        .where(F.col(time).between(F.col(start), F.col(end)))
        .drop(start, end)
        .join(has_primary, keys, "left_anti")
    )
    return primary.join(episodes.select(*keys), keys, "left_semi").unionByName(fallback)
