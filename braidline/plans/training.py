"""Training tables: per-episode robot and wrench arrays as rows, and the flat table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import asof, ordered
from braidline.functions import gripper, se3, timing


def robot_table(
    rows: DataFrame,
    episode: list[str],
    time: str,
    start: str,
    matrix: str,
    open_percent: str,
    explicit_width: list[str],
    pose_mode: str = "camera_to_tcp",
    output: str = "width_m",
) -> DataFrame:
    """pose7, gripper value and seconds of every frame of an episode."""
    posed = se3.with_tool_pose7(rows, "ts_pose_fb", matrix, pose_mode)
    unit = gripper.opening_unit(F.col(open_percent))
    width = gripper.width_m([F.col(w) for w in explicit_width], unit)
    return posed.select(
        *episode,
        time,
        timing.seconds_from_start(F.col(time), F.col(start)).alias("seconds"),
        "ts_pose_fb",
        width.alias("gripper_width_m"),
        (unit if output == "open_fraction" else width).alias("gripper"),
    )


def with_commands(rows: DataFrame, pose: str, stiffness: float = 0.0) -> DataFrame:
    """Command and virtual target as copies of the feedback, and a constant stiffness."""
    return rows.select(
        "*",
        F.col(pose).alias("ts_pose_command"),
        F.col(pose).alias("ts_pose_virtual_target"),
        F.lit(float(stiffness)).alias("stiffness"),
    )


def wrench_table(
    wrenches: DataFrame,
    robot: DataFrame,
    episode: list[str],
    time: str,
    seq: str,
    robot_seq: str,
    left: str,
    right: str,
    mode: str = "tool",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Wrenches in sensor and tool frame; the gripper width is interpolated at their times."""
    at = asof.clamped_interpolation(
        wrenches,
        asof.Stream(robot, time, robot_seq),
        episode, time, seq, ["gripper_width_m"], "w", rows_per_task,
    )
    width = F.col("w_gripper_width_m")
    tool = at.withColumn("left_tool", se3.wrench_to_tool("left", F.col(left), width, mode)).withColumn(
        "right_tool", se3.wrench_to_tool("right", F.col(right), width, mode)
    )
    return tool.withColumn("concat_sensor", F.concat(left, right)).withColumn(
        "concat_tool", F.concat("left_tool", "right_tool")
    )


def flat_table(
    timeline: DataFrame,
    episode: list[str],
    order: list[str],
    pos: Column,
    force: Column,
    open_raw: Column,
    scale: str = "auto",
    threshold: float = 0.5,
    rows_per_task: int | None = None,
) -> DataFrame:
    """pos, force, action, gripper state and action per row; labels stay inside episodes. (K5)"""
    base = timeline.select(
        *dict.fromkeys([*episode, *order]),
        pos.alias("pos"),
        force.alias("force"),
        gripper.opening_binary(open_raw, scale, threshold).alias("gripper_state"),
    )
    step = ordered.scan(
        base, episode, order, rows_per_task,
        _pos=ordered.Lead("pos"), _state=ordered.Lead("gripper_state"),
    )
    zero = F.transform("pos", lambda _: F.lit(0.0))
    return step.select(
        *base.columns,
        F.coalesce(F.zip_with("_pos", "pos", lambda a, b: a - b), zero).alias("action"),
        F.coalesce("_state", "gripper_state").alias("gripper_action"),
    )


