"""Raw streams of all runs to normalised tables on the host clock.

Inputs are tables with a run_id; every function works on all runs, sessions and
sources at once. Sessions and sources are keys, never loops. Write the results
as tables of the normalised layer before the next stage reads them: stages look
at their input more than once, to fit clocks and to cut large keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import schemas
from braidline.functions import coerce, frames, timing
from braidline.operators import clocks, labels, relations

SESSION = ["run_id", "session_id"]
SOURCE = ["run_id", "source_file"]


def phone_timing(
    frame_index: DataFrame, clock_sync: DataFrame, rows_per_task: int | None = None
) -> DataFrame:
    """Frame times on the host clock, by the session's model or its smallest delay.

    Both tables may carry the names of the files or those of ``schemas.HOST_NAMES``.
    """
    frame_index = frame_index.withColumnsRenamed(schemas.HOST_NAMES)
    clock_sync = clock_sync.withColumnsRenamed(schemas.HOST_NAMES)
    offsets = clocks.one_way_offset(
        frame_index, SESSION, "capture_timestamp_ns", "host_receive_monotonic_ns"
    )
    models = clocks.two_way_fit(
        clock_sync, SESSION, "phone_midpoint_ns", "host_midpoint_ns", "round_trip_ns",
        "request_id", rows_per_task,
    )
    timed = clocks.apply_two_way(frame_index, models, offsets, SESSION, "capture_timestamp_ns")
    received, aligned = F.col("host_receive_monotonic_ns"), F.col("aligned_ns")
    return timed.withColumn("receive_latency_ns", timing.receive_latency(received, aligned)).withColumn(
        "aligned_unix_ns", timing.aligned_unix(F.col("host_receive_unix_ns"), received, aligned)
    )


def phone_frames(
    timed: DataFrame,
    metadata: DataFrame,
    depth_index: DataFrame,
    rows_per_task: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Normalised frames, and the frames that break a rule.

    ``timed`` comes from ``phone_timing``.
    """
    by = [*SESSION, "sequence"]
    placed = labels.segment_frame_index(
        timed, [*SESSION, "video_segment"], ["sequence"], rows_per_task
    )
    matched, bad = relations.frames_with_metadata(placed, metadata, by, "capture_timestamp_ns")
    depth = depth_index.select(
        *by,
        F.col("byte_offset").alias("_d_offset"),
        F.col("byte_count").alias("_d_count"),
        F.col("width").alias("_d_width"),
        F.col("height").alias("_d_height"),
    )
    joined = relations.with_optional(matched, depth, by, ["_d_offset"], "_has_depth")
    c = F.col
    has_depth = F.coalesce(c("depth_valid"), F.lit(False)) & c("_has_depth")
    out = joined.select(
        *by,
        "aligned_ns",
        "aligned_unix_ns",
        "alignment_method",
        "receive_latency_ns",
        F.coalesce("recording_active", F.lit(False)).alias("recording_active"),
        frames.pose_payload(
            c("pose_valid"), c("world_calibrated"), c("pose_frame"), c("tracking_state"),
            c("camera_in_user_world_transform"),
        ).alias("pose"),
        frames.gripper_payload(
            c("gripper_valid"), c("gripper_open_percent"), c("gripper_timestamp_ns"),
            c("gripper_age_ns"),
        ).alias("gripper"),
        F.struct(
            F.lit(True).alias("valid"),
            F.lit("h264").alias("codec"),
            F.format_string("segment_%06d.h264", c("video_segment")).alias("video_path"),
            c("segment_frame_index").alias("frame_index"),
            c("video_byte_offset").alias("byte_offset"),
            c("video_annex_b_bytes").alias("byte_count"),
            c("key_frame"),
        ).alias("rgb"),
        F.struct(
            has_depth.alias("valid"),
            F.when(has_depth, c("_d_offset")).alias("byte_offset"),
            F.when(has_depth, c("_d_count")).alias("byte_count"),
            F.when(has_depth, c("_d_width")).otherwise(c("depth_width")).alias("width"),
            F.when(has_depth, c("_d_height")).otherwise(c("depth_height")).alias("height"),
        ).alias("depth"),
    )
    return out, bad


def phone_events(events: DataFrame, timed: DataFrame) -> DataFrame:
    """Recording events with their frame's time and readable names."""
    times = timed.select(*SESSION, "sequence", "aligned_ns")
    joined = relations.events_with_timing(events, times, [*SESSION, "sequence"])
    return joined.withColumn("event", coerce.decode(F.col("code"), coerce.EVENT_NAMES))


def camera_frames(
    camera: DataFrame, offsets: DataFrame, shape: tuple[int, int] | None = None
) -> DataFrame:
    """Camera frames on the host clock with their image pairing.

    ``offsets`` gives unix - monotonic per source as offset_ns. Rows whose own
    monotonic time is missing or zero use their wall clock.
    """
    wall = coerce.seconds_to_ns(F.col("host_receive_time_s")) - F.col("offset_ns")
    delta = timing.rgb_depth_delta_ms(
        F.col("color_sensor_timestamp_us"), F.col("depth_sensor_timestamp_us")
    )
    height, width = (F.lit(s) for s in (shape or (None, None)))
    return (
        camera.join(offsets.select(*SOURCE, "offset_ns"), SOURCE, "left")
        .withColumn("aligned_ns", coerce.first_truthy(F.col("host_receive_monotonic_ns"), wall))
        .withColumn("rgb_depth_delta_ms", delta)
        .withColumn("rgb_depth_pair_valid", timing.rgb_depth_pair_valid(F.col("rgb_depth_delta_ms")))
        .withColumn("depth_byte_offset", timing.depth_byte_offset(F.col("frame_index"), height, width))
        .drop("offset_ns")
    )


def force_samples(
    force: DataFrame, computed: Column | None = None, rows_per_task: int | None = None
) -> DataFrame:
    """Force samples on the host clock; recorded wrenches win over computed ones.

    ``computed`` is a struct column with left and right, where a model was applied.
    """
    known = force.where(F.col("host_receive_monotonic_ns").isNotNull())
    unwrapped = clocks.unwrap_counter(
        known, SOURCE, ["packet_index"], "teensy_time_us", rows_per_task
    ).withColumn("device_ns", F.col("unwrapped") * 1000)
    models = clocks.lower_envelope_fit(
        unwrapped, SOURCE, "device_ns", "host_receive_monotonic_ns", "clock_reset", rows_per_task
    )
    timed = clocks.apply_envelope(
        unwrapped, models, SOURCE, "device_ns", "host_receive_monotonic_ns", "clock_reset"
    )
    nothing = F.lit(None).cast("struct<left: array<double>, right: array<double>>")
    pair, origin = coerce.preferred_wrench(
        F.col("left_wrench"), F.col("right_wrench"), nothing if computed is None else computed
    )
    return (
        timed.withColumn("_pair", pair)
        .withColumn("calibration_source", origin)
        .withColumn("left_wrench", F.col("_pair.left"))
        .withColumn("right_wrench", F.col("_pair.right"))
        .drop("_pair", "unwrapped", "device_ns")
    )
