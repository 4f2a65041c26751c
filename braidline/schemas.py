"""Schemas of the recorded streams. They are stated, never inferred.

Column and file names are fixed values: they are those the devices write.
HOST_NAMES gives the names that the plans use for columns of the host clock.
"""

from __future__ import annotations

FRAME_INDEX = """protocol_version int, sequence long, capture_timestamp_ns long,
    mac_receive_monotonic_ns long, mac_receive_unix_ns long, video_segment int,
    video_byte_offset long, video_annex_b_bytes long, video_avcc_bytes long, key_frame boolean"""

FRAME_METADATA = """sequence long, capture_timestamp_ns long, flags int, tracking_state int,
    pose_frame int, pose_valid boolean, world_calibrated boolean, recording_active boolean,
    camera_in_user_world_transform array<double>, rgb_camera_intrinsics array<double>,
    gripper_valid boolean, gripper_timestamp_ns long, gripper_age_ns long,
    gripper_open_percent double, depth_valid boolean, depth_encoding int, depth_width int,
    depth_height int, depth_pixel_format long, depth_center_m double, depth_valid_ratio double"""

DEPTH_INDEX = """sequence long, capture_timestamp_ns long, width int, height int,
    pixel_format long, encoding string, byte_offset long, byte_count long"""

RECORDING_EVENTS = """sequence long, capture_timestamp_ns long, code int, event_index int,
    event_unix_time_ns long, app_uptime_ns long, reason string"""

CLOCK_SYNC = """session_id string, request_id long, round_trip_ns long,
    phone_midpoint_ns long, mac_midpoint_ns long"""

HOST_NAMES = {
    "mac_receive_monotonic_ns": "host_receive_monotonic_ns",
    "mac_receive_unix_ns": "host_receive_unix_ns",
    "mac_midpoint_ns": "host_midpoint_ns",
}

DEMO = """poseTimes array<string>, poseTransforms array<array<array<double>>>,
    cameraPoses array<struct<position: struct<x: double, y: double, z: double>,
        orientation: struct<x: double, y: double, z: double, w: double>>>,
    poses array<array<double>>"""

CAMERA_COLUMNS = [
    "frame_index",
    "host_receive_time_s",
    "host_receive_monotonic_ns",
    "realsense_frame_timestamp_ms",
    "realsense_timestamp_domain",
    "color_sensor_timestamp_us",
    "depth_sensor_timestamp_us",
    "color_frame_number",
    "depth_frame_number",
]

_SIDES = ("left", "right")
FORCE_COLUMNS = [
    "packet_index",
    "host_receive_monotonic_ns",
    "host_receive_unix_ns",
    "sequence_id",
    "teensy_time_us",
    *[f"{s}_c{i}" for s in _SIDES for i in range(1, 13)],
]
FORCE_CALIBRATION_COLUMNS = [
    "calibration_status",
    "calibration_error",
    "tare_count",
    "tare_target",
    *[f"{s}_zeroed_c{i}" for s in _SIDES for i in range(1, 13)],
    *[f"{s}_{a}" for s in _SIDES for a in ("fx", "fy", "fz", "mx", "my", "mz")],
]

# Names a timestamp column may have, in order of preference.
TIME_COLUMNS = ["host_receive_time_s", "frame_time_s", "timestamp_s", "time_s"]

# Files a complete phone session holds.
SESSION_FILES = [
    "SESSION.json",
    "frame_index.jsonl",
    "frame_metadata.jsonl",
    "recording_events.jsonl",
    "archive_commit.bin",
]

# The commit marker: big-endian, magic and version, eleven counters, CRC-32 of all before it.
COMMIT_BYTES = 100
COMMIT_MAGIC = "55564332"  # UVC2
COMMIT_VERSION = 2
COMMIT_FIELDS = {
    "committed_sequence": 8,
    "frame_count": 16,
    "frame_index_size": 56,
    "frame_metadata_size": 64,
    "depth_data_size": 72,
    "depth_index_size": 80,
    "recording_events_size": 88,
}
