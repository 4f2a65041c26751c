"""Expressions on clocks, frame pairs and media offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from braidline.ordered import floor_div

# Fixed value: widest accepted distance between the color and depth images of a frame.
RGB_DEPTH_PAIR_MAX_MS = 10.0


def rgb_depth_delta_ms(color_us: Column, depth_us: Column) -> Column:
    """Distance of the two image times in ms, null when one is unknown."""
    return F.abs(color_us - depth_us) / F.lit(1000.0)


def rgb_depth_pair_valid(delta_ms: Column, limit_ms: float = RGB_DEPTH_PAIR_MAX_MS) -> Column:
    """Known and within the limit."""
    return F.coalesce(delta_ms <= F.lit(limit_ms), F.lit(False))


def depth_byte_offset(frame_index: Column, height: Column, width: Column) -> Column:
    """Start of a 16-bit depth image in its file, null when anything is unknown."""
    return frame_index.cast("long") * height.cast("long") * width.cast("long") * F.lit(2)


def seconds_from_start(t_ns: Column, start_ns: Column) -> Column:
    """Seconds since the episode started."""
    return (t_ns - start_ns) / F.lit(1e9)


def camera_seconds(t_ns: Column, delta_ms: Column, start_ns: Column) -> Column:
    """Seconds of the camera image that was matched to a target."""
    shift = (F.coalesce(delta_ms, F.lit(0.0)) * F.lit(1e6)).cast("long")
    return seconds_from_start(t_ns + shift, start_ns)


def clock_sample(t1: Column, t2: Column, t3: Column, t4: Column) -> Column:
    """Four-timestamp exchange as a struct; null fields when it runs backwards.

    t1/t4 are host send and receive, t2/t3 phone receive and send.
    """
    processing = t3 - t2
    rtt = (t4 - t1) - processing
    phone_mid = t2 + floor_div(processing, 2)
    host_mid = t1 + floor_div(t4 - t1, 2)
    valid = (processing >= 0) & (t4 >= t1) & (rtt >= 0)
    return F.struct(
        valid.alias("valid"),
        F.when(valid, processing).alias("phone_processing_ns"),
        F.when(valid, rtt).alias("round_trip_ns"),
        F.when(valid, phone_mid).alias("phone_midpoint_ns"),
        F.when(valid, host_mid).alias("host_midpoint_ns"),
        F.when(valid, host_mid - phone_mid).alias("host_minus_phone_ns"),
    )


def receive_latency(receive_ns: Column, aligned_ns: Column) -> Column:
    """How long a frame was under way, never negative."""
    return F.greatest(F.lit(0).cast("long"), receive_ns - aligned_ns)


def aligned_unix(receive_unix_ns: Column, receive_ns: Column, aligned_ns: Column) -> Column:
    """Wall-clock time at which the frame was taken."""
    return receive_unix_ns - receive_latency(receive_ns, aligned_ns)
