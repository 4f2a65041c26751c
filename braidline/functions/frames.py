"""Payload structs of normalised phone frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from braidline.functions import coerce, se3

# Fixed value: ages at or below this are the device's mark for "no sample".
AGE_SENTINEL = -(1 << 62)


def pose_payload(
    flag: Column, calibrated: Column, pose_frame: Column, tracking: Column, matrix16: Column
) -> Column:
    """Pose struct: valid only when flagged, calibrated and with a usable matrix."""
    matrix = se3.flat_to_matrix(matrix16)
    ok = F.coalesce(flag, F.lit(False)) & F.coalesce(calibrated, F.lit(False)) & matrix.isNotNull()
    known = F.coalesce(calibrated, F.lit(False))
    return F.struct(
        ok.alias("valid"),
        F.when(pose_frame == 1, F.lit("user_world"))
        .otherwise(F.lit("unavailable"))
        .alias("frame"),
        known.alias("world_calibrated"),
        F.when(known, F.lit("calibrated"))
        .otherwise(F.lit("not_marked"))
        .alias("world_origin_status"),
        coerce.decode(F.coalesce(tracking, F.lit(0)), coerce.TRACKING_STATES).alias(
            "tracking_state"
        ),
        matrix.alias("camera_in_user_world"),
    )


def gripper_payload(valid: Column, open_percent: Column, sampled_ns: Column, age_ns: Column) -> Column:
    """Gripper struct; the sentinel age becomes null."""
    return F.struct(
        F.coalesce(valid, F.lit(False)).alias("valid"),
        open_percent.alias("open_percent"),
        sampled_ns.alias("phone_local_ns"),
        F.when(age_ns > AGE_SENTINEL, age_ns / F.lit(1e6)).alias("sample_age_ms"),
    )
