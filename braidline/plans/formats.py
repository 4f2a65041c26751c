"""Named output formats with default settings.

A format turns an aligned timeline into one or several tables of episodes.
``shipped()`` has those of the post-processing run; settings name the columns
of the timeline, so other timelines can be written too.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidline.functions import se3
from braidline.plans import training
from braidline.sources.episodes import EpisodeTable

Config = dict[str, Any]
Built = DataFrame | dict[str, DataFrame]


def merge_config(defaults: Config, overrides: Config | None) -> Config:
    """Overrides on top of defaults, dictionaries merged at every level. (M2)"""
    merged = dict(defaults)
    for key, value in (overrides or {}).items():
        both = isinstance(value, dict) and isinstance(merged.get(key), dict)
        merged[key] = merge_config(merged[key], value) if both else value
    return merged


@dataclass(frozen=True)
class Format:
    """A way to turn the timeline into an output table, or several by name."""

    name: str
    build: Callable[[DataFrame, Config], Built]
    defaults: Config = field(default_factory=dict)


class Formats:
    """Output formats by name. (M2)"""

    def __init__(self) -> None:
        self._known: dict[str, Format] = {}

    def add(self, fmt: Format) -> Format:
        if fmt.name in self._known:
            raise ValueError(f"format added twice: {fmt.name}")
        self._known[fmt.name] = fmt
        return fmt

    def names(self) -> list[str]:
        return sorted(self._known)

    def settings(self, name: str, overrides: Config | None = None) -> Config:
        """The format's defaults with overrides on top."""
        if name not in self._known:
            raise KeyError(f"unknown format {name!r}; known: {', '.join(self.names())}")
        return merge_config(self._known[name].defaults, overrides)

    def build(self, name: str, timeline: DataFrame, overrides: Config | None = None) -> Built:
        settings = self.settings(name, overrides)
        return self._known[name].build(timeline, settings)

    def write(
        self, name: str, timeline: DataFrame, path: str, overrides: Config | None = None
    ) -> dict[str, int]:
        """Commit the format's tables below ``path``, each an episode table; rows of each. (M2, K2)"""
        built = self.build(name, timeline, overrides)
        tables = built if isinstance(built, dict) else {name: built}
        keys = self.settings(name, overrides)["episode"]
        return {
            t: EpisodeTable(timeline.sparkSession, f"{path}/{t}", keys).write(rows)
            for t, rows in tables.items()
        }


# Where the timeline of ``plans.postprocess`` has what the formats need.
COLUMNS: Config = {
    "episode": ["run_id", "episode_index"],
    "time": "aligned_ns",
    "seq": "sequence",
    "matrix": "pose.camera_in_user_world",
    "left": "force.left_wrench",
    "right": "force.right_wrench",
    "opening": {"column": "gripper.open_percent", "scale": "auto", "threshold": 0.5},
}


def flat_training(timeline: DataFrame, c: Config) -> DataFrame:
    """One table: pos in mm and rad, force, action, gripper state and action. (K5)"""
    matrix = F.col(c["matrix"])
    turn = se3.rotation_to_rpy_deg(se3.rotation_of(se3.cells(matrix, 4, 4)))
    place = se3.translation_of(se3.cells(matrix, 4, 4))
    return training.flat_table(
        timeline,
        c["episode"],
        [c["time"], c["seq"]],
        F.array(*[p * 1000.0 for p in place], *[F.radians(a) for a in turn]),
        F.array(c["left"], c["right"]),
        F.col(c["opening"]["column"]),
        c["opening"]["scale"],
        c["opening"]["threshold"],
        c["rows_per_task"],
    )


def replay_tables(timeline: DataFrame, c: Config) -> dict[str, DataFrame]:
    """Three tables: robot poses with commands, wrenches in both frames, lengths."""
    by, time, seq = c["episode"], c["time"], c["seq"]
    flat = timeline.select(
        *by, time, seq,
        F.col(c["matrix"]).alias("_matrix"),
        F.col(c["opening"]["column"]).alias("_open"),
        F.col(c["left"]).alias("left"),
        F.col(c["right"]).alias("right"),
    )
    started = flat.join(flat.groupBy(*by).agg(F.min(time).alias("_start")), by)
    robot = training.robot_table(
        started, [*by, seq], time, "_start", "_matrix", "_open", c["robot"]["widths"],
        c["robot"]["pose_mode"], c["robot"]["gripper"],
    )
    robot = training.with_commands(robot, "ts_pose_fb", c["robot"]["stiffness"])
    wrench = training.wrench_table(
        flat.select(*by, time, seq, "left", "right"), robot, by, time, seq, seq, "left", "right",
        c["wrench_mode"], c["rows_per_task"],
    )
    lengths = flat.groupBy(*by).agg(
        F.count(F.lit(1)).alias("robot_len"), F.count("left").alias("wrench_len")
    )
    return {"robot": robot, "wrench": wrench, "lengths": lengths}


def shipped() -> Formats:
    """``flat_training`` and ``replay_tables`` with their defaults. (M2)"""
    known = Formats()
    known.add(Format("flat_training", flat_training, COLUMNS | {"rows_per_task": None}))
    robot = {"widths": [], "pose_mode": "camera_to_tcp", "gripper": "width_m", "stiffness": 0.0}
    settings = {"robot": robot, "wrench_mode": "tool", "rows_per_task": None}
    known.add(Format("replay_tables", replay_tables, COLUMNS | settings))
    return known
