"""Rotations, poses and wrenches as column expressions.

Matrices are lists of lists of columns while an expression is built, and
``array<array<double>>`` columns in a DataFrame. Chains of products should
store each intermediate matrix in a column, so that generated code stays small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Mat = list[list[Column]]

# Mounting geometry of the handheld gripper, in metres.
CAMERA_T_TCP = (
    (1.0, 0.0, 0.0, 0.039711),
    (0.0, -1.0, 0.0, -0.094423),
    (0.0, 0.0, -1.0, -0.257957),
    (0.0, 0.0, 0.0, 1.0),
)
FORCE_SENSOR_TO_CAMERA_Z_M = 0.166
FORCE_SENSOR_TO_CAMERA_Y_M = 0.081

SE3_TOLERANCE = 1e-4


def num(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def literal(rows) -> Mat:
    return [[num(x) for x in row] for row in rows]


def cells(col: Column, rows: int, cols: int) -> Mat:
    """Elements of a nested array column; missing ones are null."""
    return [[F.get(F.get(col, F.lit(i)), F.lit(j)) for j in range(cols)] for i in range(rows)]


def items(col: Column, n: int) -> list[Column]:
    return [F.get(col, F.lit(i)) for i in range(n)]


def pack(m: Mat) -> Column:
    return F.array(*[F.array(*row) for row in m])


def _total(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def matmul(a: Mat, b: Mat) -> Mat:
    """Matrix product."""
    return [
        [_total([a[i][k] * b[k][j] for k in range(len(b))]) for j in range(len(b[0]))]
        for i in range(len(a))
    ]


def transpose(m: Mat) -> Mat:
    return [list(row) for row in zip(*m)]


def rotation_y(angle_rad) -> Mat:
    """Rotation about y."""
    a = num(angle_rad)
    c, s, zero, one = F.cos(a), F.sin(a), F.lit(0.0), F.lit(1.0)
    return [[c, zero, s], [zero, one, zero], [-s, zero, c]]


def rotation_z(angle_rad) -> Mat:
    """Rotation about z."""
    a = num(angle_rad)
    c, s, zero, one = F.cos(a), F.sin(a), F.lit(0.0), F.lit(1.0)
    return [[c, -s, zero], [s, c, zero], [zero, zero, one]]


def skew(v: list[Column]) -> Mat:
    """Cross-product matrix."""
    x, y, z = v
    zero = F.lit(0.0)
    return [[zero, -z, y], [z, zero, -x], [-y, x, zero]]


def rotation_of(t: Mat) -> Mat:
    return [row[:3] for row in t[:3]]


def translation_of(t: Mat) -> list[Column]:
    return [row[3] for row in t[:3]]


def transform(r: Mat, p: list[Column]) -> Mat:
    zero, one = F.lit(0.0), F.lit(1.0)
    return [[*r[i], p[i]] for i in range(3)] + [[zero, zero, zero, one]]


def adjoint(t: Mat) -> Mat:
    """6x6 adjoint of a transform, linear part first."""
    r = rotation_of(t)
    lower = matmul(skew(translation_of(t)), r)
    zero = [F.lit(0.0)] * 3
    return [[*r[i], *zero] for i in range(3)] + [[*lower[i], *r[i]] for i in range(3)]


def inverse(t: Mat) -> Mat:
    """Inverse of a rigid transform."""
    rt = transpose(rotation_of(t))
    p = translation_of(t)
    return transform(rt, [-_total([rt[i][k] * p[k] for k in range(3)]) for i in range(3)])


def swap_halves(vector: Column) -> Column:
    """Force-moment to moment-force order, and back."""
    return F.concat(F.slice(vector, 4, 3), F.slice(vector, 1, 3))


def unit_quat(q: list[Column]) -> list[Column]:
    norm = F.sqrt(_total([x * x for x in q]))
    identity = (1.0, 0.0, 0.0, 0.0)
    return [F.when(norm > 0, x / norm).otherwise(F.lit(d)) for x, d in zip(q, identity)]


def quat_to_rotation(q: list[Column]) -> Mat:
    """Quaternion (w, x, y, z) to 3x3; it is normalised first, zero gives identity."""
    return unit_quat_to_rotation(unit_quat(q))


def unit_quat_to_rotation(q: list[Column]) -> Mat:
    w, x, y, z = q
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
        [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
        [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)],
    ]


def rotation_to_quat(r: Mat) -> Column:
    """3x3 to quaternion array (w, x, y, z), by the largest component."""
    xx, yy, zz = r[0][0], r[1][1], r[2][2]
    trace = xx + yy + zz
    dx, dy, dz = r[2][1] - r[1][2], r[0][2] - r[2][0], r[1][0] - r[0][1]
    sxy, sxz, syz = r[0][1] + r[1][0], r[0][2] + r[2][0], r[1][2] + r[2][1]

    def side(square: Column) -> Column:
        return F.sqrt(square) * 2

    sw, sx = side(trace + 1), side(1 + xx - yy - zz)
    sy, sz = side(1 + yy - xx - zz), side(1 + zz - xx - yy)
    raw = (
        F.when(trace > 0, F.array(sw / 4, dx / sw, dy / sw, dz / sw))
        .when((xx > yy) & (xx > zz), F.array(dx / sx, sx / 4, sxy / sx, sxz / sx))
        .when(yy > zz, F.array(dy / sy, sxy / sy, sy / 4, syz / sy))
        .otherwise(F.array(dz / sz, sxz / sz, syz / sz, sz / 4))
    )
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm > 0, F.transform(raw, lambda x: x / norm)).otherwise(
        F.array(*[F.lit(v) for v in (1.0, 0.0, 0.0, 0.0)])
    )


def pose7_to_transform(pose: list[Column]) -> Mat:
    """[x, y, z, qw, qx, qy, qz] to 4x4."""
    return transform(quat_to_rotation(pose[3:7]), pose[:3])


def transform_to_pose7(t: Mat) -> Column:
    """4x4 to [x, y, z, qw, qx, qy, qz]."""
    return F.concat(F.array(*translation_of(t)), rotation_to_quat(rotation_of(t)))


def rpy_deg_to_quat(roll: Column, pitch: Column, yaw: Column) -> list[Column]:
    """Roll, pitch, yaw in degrees (applied x, then y, then z) to a unit quaternion."""
    half = [F.radians(a) / 2 for a in (roll, pitch, yaw)]
    (cr, cp, cy), (sr, sp, sy) = [F.cos(h) for h in half], [F.sin(h) for h in half]
    return unit_quat(
        [
            cr * cp * cy + sr * sp * sy,
            sr * cp * cy - cr * sp * sy,
            cr * sp * cy + sr * cp * sy,
            cr * cp * sy - sr * sp * cy,
        ]
    )


def rotation_to_rpy_deg(r: Mat) -> list[Column]:
    """3x3 to roll, pitch, yaw in degrees."""
    sine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -r[2][0]))
    return [
        F.degrees(F.atan2(r[2][1], r[2][2])),
        F.degrees(F.asin(sine)),
        F.degrees(F.atan2(r[1][0], r[0][0])),
    ]


def rotation_to_rotvec(r: Mat, degrees: bool = False) -> list[Column]:
    """3x3 to axis times angle; angles below 1e-8 give zero."""
    cosine = (r[0][0] + r[1][1] + r[2][2] - 1) / 2
    theta = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    axis = [r[2][1] - r[1][2], r[0][2] - r[2][0], r[1][0] - r[0][1]]
    sine = F.sin(theta) * 2
    out = [
        F.when((theta < 1e-8) | (sine == 0), F.lit(0.0)).otherwise(a / sine * theta) for a in axis
    ]
    return [F.degrees(v) for v in out] if degrees else out


def flat_to_matrix(values: Column) -> Column:
    """16 values to 4x4, null unless there are 16 finite ones."""
    inf = float("inf")
    usable = (F.size(values) == 16) & F.forall(
        values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf)
    )
    return F.when(usable, F.array(*[F.slice(values, 4 * i + 1, 4) for i in range(4)]))


def validate_se3(matrix: Column, tolerance: float = SE3_TOLERANCE) -> Column:
    """Struct (ok, reason): the first rule a 4x4 breaks to be a rigid transform."""
    m = cells(matrix, 4, 4)
    flat = F.flatten(matrix)
    inf = float("inf")
    shaped = (F.size(matrix) == 4) & F.forall(matrix, lambda row: F.size(row) == 4)
    finite = F.forall(flat, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf))

    def close(x: Column, y: float) -> Column:
        return F.abs(x - y) <= tolerance

    def every(conds: list[Column]) -> Column:
        out = conds[0]
        for c in conds[1:]:
            out = out & c
        return out

    bottom = every([close(m[3][j], float(j == 3)) for j in range(4)])
    r = [[x / m[3][3] for x in row] for row in rotation_of(m)]
    gram = matmul(transpose(r), r)
    orthonormal = every([close(gram[i][j], float(i == j)) for i in range(3) for j in range(i, 3)])
    det = (
        r[0][0] * (r[1][1] * r[2][2] - r[1][2] * r[2][1])
        - r[0][1] * (r[1][0] * r[2][2] - r[1][2] * r[2][0])
        + r[0][2] * (r[1][0] * r[2][1] - r[1][1] * r[2][0])
    )
    reason = (
        F.when(matrix.isNull(), F.lit("missing"))
        .when(~F.coalesce(shaped, F.lit(False)), F.lit("not_4x4"))
        .when(~finite, F.lit("not_finite"))
        .when(~bottom, F.lit("bottom_row"))
        .when(~orthonormal, F.lit("not_orthonormal"))
        .when(~close(det, 1.0), F.lit("determinant"))
    )
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


def rescaled(matrix: Column) -> Column:
    """The transform divided by its last element, with an exact bottom row."""
    m = cells(matrix, 4, 4)
    top = [[x / m[3][3] for x in row] for row in m[:3]]
    return F.when(
        matrix.isNotNull(), pack(top + [[F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)]])
    )


def with_source_pose(
    df: DataFrame, name: str, matrix: Column, xyz: list[Column], quat: Column, rpy_deg: list[Column]
) -> DataFrame:
    """Add the camera pose as 4x4: the matrix if present, else quaternion, else angles.

    Every step is a column of its own, so that Spark evaluates it once and the
    generated code stays small.
    """
    xyz = [F.coalesce(v, F.lit(0.0)) for v in xyz]
    rpy = [F.coalesce(v, F.lit(0.0)) for v in rpy_deg]
    chosen = F.coalesce(quat, F.array(*rpy_deg_to_quat(*rpy)))
    staged = df.withColumn("_q", chosen).withColumn(
        "_q", F.array(*unit_quat(items(F.col("_q"), 4)))
    )
    built = pack(transform(unit_quat_to_rotation(items(F.col("_q"), 4)), xyz))
    return staged.withColumn(name, F.coalesce(rescaled(matrix), built)).drop("_q")


def with_tool_pose7(
    df: DataFrame, name: str, matrix: str, mode: str = "camera_to_tcp", extrinsic=CAMERA_T_TCP
) -> DataFrame:
    """Add the tool's pose7: the camera pose composed with the mounting, or passed through. (X11)"""
    if mode not in ("camera_to_tcp", "passthrough"):
        raise ValueError(f"unknown pose mode: {mode}")
    m = cells(F.col(matrix), 4, 4)
    if mode == "camera_to_tcp":
        m = matmul(m, literal(extrinsic))
    staged = df.withColumn("_t", F.when(F.col(matrix).isNotNull(), pack(m)))
    return staged.withColumn(
        name,
        F.when(F.col("_t").isNotNull(), transform_to_pose7(cells(F.col("_t"), 4, 4))),
    ).drop("_t")


def relative_pose(base: Column, other: Column) -> Column:
    """``inv(base) * other`` as 4x4."""
    return pack(matmul(inverse(cells(base, 4, 4)), cells(other, 4, 4)))


def pose6_mm_rad(
    valid: Column, calibrated: Column, frame: Column, xyz_m: list[Column], rpy_deg: list[Column]
) -> Column:
    """Struct (value, reason): [mm, mm, mm, rad, rad, rad] or why there is none."""
    inf = float("inf")
    numbers = [*xyz_m, *rpy_deg]
    complete = F.lit(True)
    for n in numbers:
        complete = complete & n.isNotNull() & ~F.isnan(n) & (F.abs(n) < inf)
    reason = (
        F.when(~F.coalesce(valid, F.lit(False)), F.lit("pose_invalid"))
        .when(~F.coalesce(calibrated, F.lit(False)), F.lit("world_not_calibrated"))
        .when(~F.coalesce(frame == "user_world", F.lit(False)), F.lit("wrong_frame"))
        .when(~complete, F.lit("missing_numbers"))
    )
    value = F.array(*[v * 1000.0 for v in xyz_m], *[F.radians(a) for a in rpy_deg])
    return F.struct(F.when(reason.isNull(), value).alias("value"), reason.alias("reason"))


def linear_map(vector: Column, matrix, offset) -> Column:
    """``matrix * vector + offset`` with a fixed matrix."""
    rows = []
    for coefficients, b in zip(matrix, offset):
        terms = [F.get(vector, F.lit(i)) * float(a) for i, a in enumerate(coefficients)]
        rows.append(_total(terms) + float(b))
    return F.when(F.size(vector) == len(matrix[0]), F.array(*rows))


def sensor_transform(
    side: str,
    width_m: Column,
    z_m: float = FORCE_SENSOR_TO_CAMERA_Z_M,
    y_m: float = FORCE_SENSOR_TO_CAMERA_Y_M,
) -> Mat:
    """Pose of a finger's force sensor in the tool frame for a gripper width."""
    half = F.greatest(F.lit(0.0), width_m) / 2
    quarter, turn = math.pi / 2, math.pi
    if side == "left":
        return transform(rotation_y(-quarter), [F.lit(z_m), F.lit(-y_m), half])
    if side == "right":
        r = matmul(rotation_z(turn), rotation_y(quarter))
        return transform(r, [F.lit(z_m), F.lit(y_m), half])
    raise ValueError(f"unknown side: {side}")


def wrench_to_tool(
    side: str, force_moment: Column, width_m: Column, mode: str = "tool", **geometry: float
) -> Column:
    """Force-moment of one finger in the tool frame."""
    if mode == "passthrough":
        return force_moment
    if mode != "tool":
        raise ValueError(f"unknown wrench mode: {mode}")
    f = items(force_moment, 6)
    moment_first = [[x] for x in f[3:] + f[:3]]
    adj_t = transpose(adjoint(sensor_transform(side, width_m, **geometry)))
    out = [row[0] for row in matmul(adj_t, moment_first)]
    return F.when(F.size(force_moment) == 6, F.array(*out[3:], *out[:3]))


def session_world(anchor: Column, camera: Column, snap_deg: float = 90.0) -> Column:
    """Camera pose in a session world whose heading is snapped to a right angle.

    ``anchor`` is the camera pose at calibration: its x axis, laid flat, gives
    the heading, world y is up and becomes the session's z axis. Returns a
    struct with the pose (4x4), the snapped heading, and the tilt and heading
    errors in degrees.
    """
    a = cells(anchor, 4, 4)
    length = F.sqrt(_total([a[i][2] * a[i][2] for i in range(3)]))
    forward_up = -a[1][2] / F.when(length > 1e-4, length)
    heading = F.degrees(F.atan2(a[2][0], a[0][0]))
    snapped = F.round(heading / snap_deg) * snap_deg
    c, s = F.cos(F.radians(snapped)), F.sin(F.radians(snapped))
    zero, one = F.lit(0.0), F.lit(1.0)
    world = transform([[c, s, zero], [zero, zero, one], [s, -c, zero]], translation_of(a))
    pose = matmul(inverse(world), cells(camera, 4, 4))
    off = F.radians(heading - snapped)
    up = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), forward_up))
    flat = F.hypot(a[0][0], a[2][0])
    return F.when(
        flat > 1e-4,
        F.struct(
            pack(pose).alias("pose"),
            F.pmod(snapped, F.lit(360.0)).alias("heading_deg"),
            F.degrees(F.acos(up)).alias("tilt_error_deg"),
            F.degrees(F.abs(F.atan2(F.sin(off), F.cos(off)))).alias("heading_error_deg"),
        ),
    )


def grasp_force(left_fx: Column, right_fx: Column) -> Column:
    """Squeezing force of the two fingers. (P20)"""
    return (right_fx - left_fx) / 2


def combined_force(left: Column, right: Column) -> Column:
    """Sum of both fingers in the left sensor's frame: the right one's y and z are flipped. (P20)"""
    signs = (1.0, -1.0, -1.0)
    return F.array(
        *[F.get(left, F.lit(i)) + F.get(right, F.lit(i)) * s for i, s in enumerate(signs)]
    )


def reference_wrench(raw: Column, tare: Column, matrix, arm_m: float) -> Column:
    """Calibrated reference sensor: ``(raw - tare) * M'`` moved along a moment arm."""
    zeroed = F.zip_with(raw, tare, lambda a, b: a - b)
    w = items(linear_map(zeroed, matrix, [0.0] * len(matrix)), 6)
    return F.array(w[0], w[1], w[2], w[3] + w[1] * arm_m, w[4] - w[0] * arm_m, w[5])


def residual(reference: Column, sensor: Column) -> Column:
    """Reference minus sensor, element by element."""
    return F.zip_with(reference, sensor, lambda a, b: a - b)


def point_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of two points in the image."""
    return F.hypot(bx - ax, by - ay)


def point_between(
    ax: Column, ay: Column, bx: Column, by: Column, t: Column
) -> tuple[Column, Column]:
    """Point at parameter t of a segment, t clamped to 0..1."""
    u = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return ax + (bx - ax) * u, ay + (by - ay) * u


def project_on_segment(
    px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column
) -> Column:
    """Struct (t, error, length) of a point projected on a segment."""
    vx, vy = bx - ax, by - ay
    square = vx * vx + vy * vy
    usable = square > 1e-9
    raw = ((px - ax) * vx + (py - ay) * vy) / F.when(usable, square)
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), F.lit(0.0))
    error = F.hypot(px - (ax + t * vx), py - (ay + t * vy))
    return F.struct(
        t.alias("t"),
        error.alias("error"),
        F.when(usable, F.sqrt(square)).otherwise(F.lit(0.0)).alias("length"),
    )
