"""Invariants of the pose and wrench expressions, against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidline.functions import gripper, se3


def poses(spark, n=20):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        q, _ = np.linalg.qr(rng.standard_normal((3, 3)))
        q *= np.sign(np.linalg.det(q))
        m = np.eye(4)
        m[:3, :3], m[:3, 3] = q, rng.standard_normal(3)
        rows.append((i, m.tolist(), rng.standard_normal(6).tolist(), float(rng.random() * 0.1)))
    return spark.createDataFrame(rows, "i long, m array<array<double>>, w array<double>, width double")


def test_identity_pose_gives_the_mounting(spark):
    df = spark.createDataFrame([(np.eye(4).tolist(),)], "m array<array<double>>")
    p = se3.with_tool_pose7(df, "p", "m").first()["p"]
    assert p[:3] == pytest.approx([0.039711, -0.094423, -0.257957])
    assert np.abs(p[3:]) == pytest.approx([0, 1, 0, 0])


def test_quaternion_round_trip(spark):
    df = poses(spark)
    back = df.withColumn("p", se3.transform_to_pose7(se3.cells(F.col("m"), 4, 4))).withColumn(
        "b", se3.pack(se3.pose7_to_transform(se3.items(F.col("p"), 7)))
    )
    for r in back.collect():
        assert np.array(r["b"]) == pytest.approx(np.array(r["m"]), abs=1e-9)


def test_relative_motion_does_not_depend_on_the_world(spark):
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((3, 3)))
    q *= np.sign(np.linalg.det(q))
    world = np.eye(4)
    world[:3, :3], world[:3, 3] = q, [1, 2, 3]
    df = poses(spark).withColumn("o", F.lit(None))
    m = se3.cells(F.col("m"), 4, 4)
    moved = df.withColumn("m2", se3.pack(se3.matmul(se3.literal(world.tolist()), m))).withColumn(
        "anchor", F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in np.eye(4)])
    )
    anchor2 = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in world])
    out = moved.withColumn("a", se3.relative_pose(F.col("anchor"), F.col("m"))).withColumn(
        "b", se3.relative_pose(anchor2, F.col("m2"))
    )
    for r in out.collect():
        assert np.array(r["a"]) == pytest.approx(np.array(r["b"]), abs=1e-9)


def test_wrench_to_tool_matches_the_adjoint(spark):
    def skew(p):
        return np.array([[0, -p[2], p[1]], [p[2], 0, -p[0]], [-p[1], p[0], 0]])

    def rot(axis, a):
        c, s = math.cos(a), math.sin(a)
        if axis == "y":
            return np.array([[c, 0, s], [0, 1, 0], [-s, 0, c]])
        return np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])

    df = poses(spark).select(
        "w", "width",
        se3.wrench_to_tool("left", F.col("w"), F.col("width")).alias("left"),
        se3.wrench_to_tool("right", F.col("w"), F.col("width")).alias("right"),
        se3.wrench_to_tool("left", F.col("w"), F.col("width"), "passthrough").alias("same"),
    )
    turns = {"left": (rot("y", -math.pi / 2), -1), "right": (rot("z", math.pi) @ rot("y", math.pi / 2), 1)}
    for r in df.collect():
        assert r["same"] == r["w"]
        for side, (turn, sign) in turns.items():
            p = np.array([0.166, sign * 0.081, r["width"] / 2])
            adj = np.zeros((6, 6))
            adj[:3, :3] = adj[3:, 3:] = turn
            adj[3:, :3] = skew(p) @ turn
            v = adj.T @ np.array(r["w"][3:] + r["w"][:3])
            assert r[side] == pytest.approx(np.concatenate([v[3:], v[:3]]), abs=1e-12)


def test_unknown_modes_are_errors():
    with pytest.raises(ValueError):
        se3.wrench_to_tool("left", F.lit(1), F.lit(1), "other")
    with pytest.raises(ValueError):
        gripper.opening_unit(F.lit(1.0), "other")


def test_gripper_scales(spark):
    df = spark.createDataFrame([(1.0,), (50.0,), (0.4,), (None,), (float("nan"),), (150.0,)], "x double")
    got = [r["u"] for r in df.select(gripper.opening_unit(F.col("x")).alias("u")).collect()]
    assert got == [1.0, 0.5, 0.4, 0.0, 0.0, 1.0]
