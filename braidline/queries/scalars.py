"""Queries: text, time and array expressions, poses and wrenches."""

from __future__ import annotations


from pyspark.sql import functions as F

from braidline.functions import coerce, frames, gripper, se3, timing
from braidline.ordered import floor_div
from braidline.queries.base import EV, VEC, Tables, q6, query, r6, r_items

# texts of every kind the coercion must survive
TEXTS = f"""(SELECT event_id, CASE event_id % 7 WHEN 0 THEN value::VARCHAR WHEN 1 THEN ' ' || event_id::VARCHAR || ' '
  WHEN 2 THEN '' WHEN 3 THEN 'junk' WHEN 4 THEN '   ' WHEN 5 THEN '-' || value::VARCHAR
  ELSE props END AS s FROM {EV})"""


def texts(t: Tables):
    e, v = F.col("event_id"), F.col("value").cast("string")
    s = (
        F.when(e % 7 == 0, v)
        .when(e % 7 == 1, F.concat(F.lit(" "), e.cast("string"), F.lit(" ")))
        .when(e % 7 == 2, "")
        .when(e % 7 == 3, "junk")
        .when(e % 7 == 4, "   ")
        .when(e % 7 == 5, F.concat(F.lit("-"), v))
        .otherwise(F.col("props"))
    )
    return t.events().select("event_id", s.alias("s"))


@query(
    "p1_lenient_coercion",
    f"""SELECT event_id, trunc(TRY_CAST(trim(s) AS DOUBLE))::BIGINT AS as_long,
  TRY_CAST(nullif(trim(s), '') AS DOUBLE) AS as_double, nullif(trim(s), '') AS as_text FROM {TEXTS}""",
)
def p1_lenient_coercion(t: Tables):
    s = F.col("s")
    return texts(t).select(
        "event_id",
        coerce.to_long(s).alias("as_long"),
        coerce.to_double(s).alias("as_double"),
        coerce.text(s).alias("as_text"),
    )


@query(
    "p2_first_truthy_time",
    f"""SELECT event_id, coalesce(nullif(CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN t END, 0), event_id) AS at FROM {EV}""",
)
def p2_first_truthy_time(t: Tables):
    e = F.col("event_id")
    first = F.when(e % 3 == 0, F.lit(0)).when(e % 3 == 1, F.col("t"))
    return t.events().select("event_id", coerce.first_truthy(first, e).alias("at"))


CHANNELS = f"""(SELECT vec_id, [CASE WHEN vec_id % 4 = 0 AND i = 3 THEN NULL ELSE e[i] END FOR i IN range(1, 13)] AS c FROM {VEC})"""


def channel_columns(t: Tables):
    """Twelve channel columns, one of them null on every fourth row."""
    cols = []
    for i in range(1, 13):
        c = F.get("e", F.lit(i - 1))
        cols.append((F.when(F.col("vec_id") % 4 != 0, c) if i == 3 else c).alias(f"left_c{i}"))
    return t.vectors().select("vec_id", "label", "e", *cols)


@query(
    "p3_channel_array",
    f"SELECT vec_id, len(c) AS n, {q6('c[3]')} AS third, {q6('c[12]')} AS last FROM {CHANNELS}",
)
def p3_channel_array(t: Tables):
    a = coerce.channel_array("left_c")
    return channel_columns(t).select("vec_id", a.alias("a")).select(
        "vec_id",
        F.size("a").cast("long").alias("n"),
        r6(F.get("a", F.lit(2))).alias("third"),
        r6(F.get("a", F.lit(11))).alias("last"),
    )


@query(
    "p4_complete_vector",
    f"SELECT vec_id, CASE WHEN vec_id % 4 <> 0 THEN {q6('c[1]')} END AS first FROM {CHANNELS}",
)
def p4_complete_vector(t: Tables):
    a = coerce.complete_vector(coerce.channel_array("left_c"))
    return channel_columns(t).select("vec_id", r6(F.get(a, F.lit(0))).alias("first"))


@query(
    "p5_preferred_wrench",
    f"""SELECT vec_id, {q6("CASE WHEN vec_id % 3 > 0 THEN e[1] WHEN vec_id % 2 = 0 THEN e[20] END")} AS left_fx,
  CASE WHEN vec_id % 3 > 0 THEN 'recorded' WHEN vec_id % 2 = 0 THEN 'offline_model' ELSE 'raw_only' END AS origin FROM {VEC}""",
)
def p5_preferred_wrench(t: Tables):
    v, e = F.col("vec_id"), F.col("e")
    left = F.when(v % 3 > 0, F.slice(e, 1, 6)).otherwise(F.slice(e, 1, 5))
    computed = F.when(
        v % 2 == 0, F.struct(F.slice(e, 20, 6).alias("left"), F.slice(e, 26, 6).alias("right"))
    )
    pair, origin = coerce.preferred_wrench(left, F.slice(e, 7, 6), computed)
    return t.vectors().select(
        "vec_id", r6(F.get(pair["left"], F.lit(0))).alias("left_fx"), origin.alias("origin")
    )


@query(
    "p6_image_pairing",
    f"""SELECT event_id, {q6("CASE WHEN event_id % 5 > 0 THEN abs(value * 300)::BIGINT / 1000.0 END")} AS delta_ms,
  coalesce(event_id % 5 > 0 AND abs(value * 300)::BIGINT / 1000.0 <= 10, false) AS pair_valid FROM {EV}""",
)
def p6_image_pairing(t: Tables):
    color = F.col("t")
    shift = F.rint(F.col("value") * 300).cast("long")
    depth = F.when(F.col("event_id") % 5 > 0, color + shift)
    d = timing.rgb_depth_delta_ms(color, depth)
    return t.events().select(
        "event_id", r6(d).alias("delta_ms"), timing.rgb_depth_pair_valid(d).alias("pair_valid")
    )


@query(
    "p7_depth_offset",
    f"SELECT event_id, CASE WHEN event_id % 4 > 0 THEN event_id * 480 * 640 * 2 END AS byte_offset FROM {EV}",
)
def p7_depth_offset(t: Tables):
    height = F.when(F.col("event_id") % 4 > 0, F.lit(480))
    return t.events().select(
        "event_id",
        timing.depth_byte_offset(F.col("event_id"), height, F.lit(640)).alias("byte_offset"),
    )


@query(
    "p8_flat_to_matrix",
    f"""SELECT vec_id, {q6("CASE WHEN vec_id % 5 > 0 THEN e[7] END")} AS m12,
  {q6("CASE WHEN vec_id % 5 > 0 THEN e[16] END")} AS m33 FROM {VEC}""",
)
def p8_flat_to_matrix(t: Tables):
    n = F.when(F.col("vec_id") % 5 > 0, 16).otherwise(15)
    m = se3.flat_to_matrix(F.slice("e", F.lit(1), n))
    return t.vectors().select("vec_id", m.alias("m")).select(
        "vec_id",
        r6(F.get(F.get("m", F.lit(1)), F.lit(2))).alias("m12"),
        r6(F.get(F.get("m", F.lit(3)), F.lit(3))).alias("m33"),
    )


@query(
    "p9_pose_validity",
    f"""SELECT vec_id, vec_id % 3 <> 0 AND vec_id % 7 <> 2 AND vec_id % 5 > 0 AS valid,
  CASE WHEN vec_id % 2 = 1 THEN 'user_world' ELSE 'unavailable' END AS frame,
  {q6("CASE WHEN vec_id % 6 > 0 THEN vec_id * 1000 / 1e6 END")} AS age_ms FROM {VEC}""",
)
def p9_pose_validity(t: Tables):
    v = F.col("vec_id")
    matrix = F.slice("e", F.lit(1), F.when(v % 5 > 0, 16).otherwise(15))
    pose = frames.pose_payload(v % 3 != 0, v % 7 != 2, v % 2, v % 4, matrix)
    age = F.when(v % 6 > 0, v * 1000).otherwise(F.lit(frames.AGE_SENTINEL))
    grip = frames.gripper_payload(F.lit(True), F.lit(50.0), v, age)
    return t.vectors().select("vec_id", pose.alias("p"), grip.alias("g")).select(
        "vec_id", "p.valid", "p.frame", r6("g.sample_age_ms").alias("age_ms")
    )


@query(
    "p10_enum_decode",
    f"""SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'force_restart_requested' WHEN 2 THEN 'record_start'
  WHEN 3 THEN 'record_stop' WHEN 4 THEN 'record_discard' ELSE 'unknown' END AS event,
  CASE event_id % 5 WHEN 1 THEN 'normal' WHEN 2 THEN 'limited' WHEN 3 THEN 'unavailable' ELSE 'unknown' END
  AS tracking FROM {EV}""",
)
def p10_enum_decode(t: Tables):
    e = F.col("event_id")
    return t.events().select(
        "event_id",
        coerce.decode(e % 6, coerce.EVENT_NAMES).alias("event"),
        coerce.decode(e % 5, coerce.TRACKING_STATES).alias("tracking"),
    )


@query(
    "p11_seconds_from_start",
    f"""WITH s AS (SELECT user_id, min(t) AS s FROM {EV} GROUP BY 1)
  SELECT event_id, {q6("(t - s) / 1e9")} AS seconds,
    {q6("(t + trunc((value - 20) * 1e6)::BIGINT - s) / 1e9")} AS camera_seconds FROM {EV} JOIN s USING (user_id)""",
)
def p11_seconds_from_start(t: Tables):
    rows = t.events()
    start = rows.groupBy("user_id").agg(F.min("t").alias("s"))
    s, at = F.col("s"), F.col("t")
    return rows.join(start, "user_id").select(
        "event_id",
        r6(timing.seconds_from_start(at, s)).alias("seconds"),
        r6(timing.camera_seconds(at, F.col("value") - 20, s)).alias("camera_seconds"),
    )


OPENING = "CASE event_id % 3 WHEN 0 THEN value WHEN 1 THEN value / 100 ELSE NULL END"


def opening():
    e, v = F.col("event_id"), F.col("value")
    return F.when(e % 3 == 0, v).when(e % 3 == 1, v / 100)


@query(
    "p12_opening_unit",
    f"""WITH o AS (SELECT event_id, {OPENING} AS o FROM {EV})
  SELECT event_id, {q6("CASE WHEN o IS NULL THEN 0 ELSE greatest(0, least(1, CASE WHEN o > 1 THEN o / 100 ELSE o END)) END")} AS auto_unit,
    {q6("CASE WHEN o IS NULL THEN 0 ELSE greatest(0, least(1, o / 100)) END")} AS percent_unit,
    {q6("CASE WHEN o IS NULL THEN 0 ELSE greatest(0, least(1, o)) END")} AS unit FROM o""",
)
def p12_opening_unit(t: Tables):
    o = opening()
    return t.events().select(
        "event_id",
        r6(gripper.opening_unit(o)).alias("auto_unit"),
        r6(gripper.opening_unit(o, "percent")).alias("percent_unit"),
        r6(gripper.opening_unit(o, "unit")).alias("unit"),
    )


@query(
    "p13_opening_binary",
    f"""WITH o AS (SELECT event_id, {OPENING} AS o FROM {EV})
  SELECT event_id, CASE WHEN coalesce(CASE WHEN o > 1 THEN o / 100 ELSE o END, 0) >= 0.5
    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS state FROM o""",
)
def p13_opening_binary(t: Tables):
    return t.events().select("event_id", gripper.opening_binary(opening()).alias("state"))


@query(
    "p14_gripper_width",
    f"""SELECT event_id, {q6('''CASE WHEN event_id % 4 = 0 THEN value / 1000 WHEN event_id % 4 = 1 THEN value / 500
  ELSE 0.01 + least(1, value / 100) * 0.06 END''')} AS width FROM {EV}""",
)
def p14_gripper_width(t: Tables):
    e, v = F.col("event_id"), F.col("value")
    first = F.when(e % 4 == 0, v / 1000).when(e % 4 == 1, F.lit(-1.0))
    second = F.when(e % 4 < 2, v / 500)
    w = gripper.width_m([first, second], v / 100, low=0.07, high=0.01)
    return t.events().select("event_id", r6(w).alias("width"))


@query(
    "p15_pose_mm_rad",
    f"""SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN 'pose_invalid' WHEN vec_id % 4 = 1 THEN 'world_not_calibrated'
    WHEN vec_id % 5 = 2 THEN 'wrong_frame' WHEN vec_id % 7 = 3 THEN 'missing_numbers' END AS reason,
  {q6("CASE WHEN vec_id % 3 <> 0 AND vec_id % 4 <> 1 AND vec_id % 5 <> 2 AND vec_id % 7 <> 3 THEN e[1] * 1000 END")} AS x_mm,
  {q6("CASE WHEN vec_id % 3 <> 0 AND vec_id % 4 <> 1 AND vec_id % 5 <> 2 AND vec_id % 7 <> 3 THEN radians(e[4] * 100) END")} AS roll
  FROM {VEC}""",
)
def p15_pose_mm_rad(t: Tables):
    v = F.col("vec_id")
    e = [F.get("e", F.lit(i)) for i in range(6)]
    x = F.when(v % 7 != 3, e[0])
    frame = F.when(v % 5 != 2, "user_world").otherwise("unavailable")
    p = se3.pose6_mm_rad(v % 3 != 0, v % 4 != 1, frame, [x, e[1], e[2]], [a * 100 for a in e[3:]])
    return t.vectors().select("vec_id", p.alias("p")).select(
        "vec_id",
        "p.reason",
        r6(F.get("p.value", F.lit(0))).alias("x_mm"),
        r6(F.get("p.value", F.lit(3))).alias("roll"),
    )


# a fixed map with a different weight in every place
MAP = [[(i + 1) * 0.5 - (j % 3) for j in range(6)] for i in range(6)]
OFFSET = [0.25 * i for i in range(6)]


def _map_sql(i: int) -> str:
    return q6(" + ".join(f"e[{j + 1}] * {MAP[i][j]}::DOUBLE" for j in range(6)) + f" + {OFFSET[i]}")


@query("p16_linear_map", f"SELECT vec_id, {_map_sql(0)} AS y0, {_map_sql(5)} AS y5 FROM {VEC}")
def p16_linear_map(t: Tables):
    y = se3.linear_map(F.slice("e", 1, 6), MAP, OFFSET)
    return t.vectors().select("vec_id", y.alias("y")).select(
        "vec_id", r6(F.get("y", F.lit(0))).alias("y0"), r6(F.get("y", F.lit(5))).alias("y5")
    )


@query(
    "p18_iso_time",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso, epoch_us(ts) * 1000 AS back,
  trunc(epoch_us(ts)::DOUBLE / 1e6 * 1e9)::BIGINT // 1000000 AS from_seconds FROM events""",
)
def p18_iso_time(t: Tables):
    iso = coerce.ns_to_iso(F.col("t"))
    seconds = floor_div(F.col("t"), 1000).cast("double") / F.lit(1e6)
    return t.events().select(
        "event_id",
        iso.alias("iso"),
        coerce.iso_to_ns(iso).alias("back"),
        floor_div(coerce.seconds_to_ns(seconds), 1_000_000).alias("from_seconds"),
    )


CLOCK = f"""(SELECT event_id, t AS t1, t - 5000000000 + event_id AS t2, t - 5000000000 + event_id
  + (value * 1000)::BIGINT - 2000 AS t3, t + (value * 2000)::BIGINT - 1000 AS t4 FROM {EV})"""


@query(
    "p19_clock_sample",
    f"""WITH c AS (SELECT *, t3 - t2 AS p, (t4 - t1) - (t3 - t2) AS r, t2 + floor((t3 - t2) / 2)::BIGINT AS pm,
    t1 + floor((t4 - t1) / 2)::BIGINT AS hm, t3 >= t2 AND t4 >= t1 AND (t4 - t1) - (t3 - t2) >= 0 AS ok FROM {CLOCK})
  SELECT event_id, ok AS valid, CASE WHEN ok THEN r END AS rtt, CASE WHEN ok THEN pm END AS phone_mid,
    CASE WHEN ok THEN hm - pm END AS host_minus_phone FROM c""",
)
def p19_clock_sample(t: Tables):
    e, at = F.col("event_id"), F.col("t")
    us = F.rint(F.col("value") * 1000).cast("long")
    us2 = F.rint(F.col("value") * 2000).cast("long")
    t2 = at - 5_000_000_000 + e
    c = timing.clock_sample(at, t2, t2 + us - 2000, at + us2 - 1000)
    return t.events().select("event_id", c.alias("c")).select(
        "event_id",
        "c.valid",
        F.col("c.round_trip_ns").alias("rtt"),
        F.col("c.phone_midpoint_ns").alias("phone_mid"),
        F.col("c.host_minus_phone_ns").alias("host_minus_phone"),
    )


@query(
    "p20_grasp_force",
    f"""SELECT vec_id, {q6("(e[7] - e[1]) / 2")} AS grasp, {q6("e[1] + e[7]")} AS fx, {q6("e[2] - e[8]")} AS fy FROM {VEC}""",
)
def p20_grasp_force(t: Tables):
    left, right = F.slice("e", 1, 6), F.slice("e", 7, 6)
    both = se3.combined_force(left, right)
    return t.vectors().select(
        "vec_id",
        r6(se3.grasp_force(F.get(left, F.lit(0)), F.get(right, F.lit(0)))).alias("grasp"),
        r6(F.get(both, F.lit(0))).alias("fx"),
        r6(F.get(both, F.lit(1))).alias("fy"),
    )


@query(
    "p21_receive_latency",
    f"""SELECT event_id, greatest(0, (value * 1000)::BIGINT - 10000) AS latency,
  t + 7 - greatest(0, (value * 1000)::BIGINT - 10000) AS aligned_unix FROM {EV}""",
)
def p21_receive_latency(t: Tables):
    at = F.col("t")
    receive = at + F.rint(F.col("value") * 1000).cast("long") - 10_000
    return t.events().select(
        "event_id",
        timing.receive_latency(receive, at).alias("latency"),
        timing.aligned_unix(at + 7, receive, at).alias("aligned_unix"),
    )


# ---------------------------------------------------------------------------
# poses: quaternion e[1..4] (w, x, y, z), position e[5..7]

QN = f"""(SELECT vec_id, label, e, e[1] / n AS w, e[2] / n AS x, e[3] / n AS y, e[4] / n AS z FROM
  (SELECT *, sqrt(e[1]**2 + e[2]**2 + e[3]**2 + e[4]**2) AS n FROM {VEC}))"""
R = {
    "00": "1 - 2*(y*y + z*z)", "01": "2*(x*y - w*z)", "02": "2*(x*z + w*y)",
    "10": "2*(x*y + w*z)", "11": "1 - 2*(x*x + z*z)", "12": "2*(y*z - w*x)",
    "20": "2*(x*z - w*y)", "21": "2*(y*z + w*x)", "22": "1 - 2*(x*x + y*y)",
}


def posed(t: Tables):
    """Vectors with their pose as 4x4 in ``m``."""
    e = [F.get("e", F.lit(i)) for i in range(7)]
    m = se3.pose7_to_transform([*e[4:7], *e[:4]])
    return t.vectors().withColumn("m", se3.pack(m))


def cell(i: int, j: int, col: str = "m"):
    return F.get(F.get(col, F.lit(i)), F.lit(j))


@query(
    "x1_axis_rotations",
    f"""SELECT vec_id, {q6("cos(e[1])")} AS y00, {q6("sin(e[1])")} AS y02, {q6("-sin(e[1])")} AS y20,
  {q6("-sin(e[2])")} AS z01, {q6("sin(e[2])")} AS z10 FROM {VEC}""",
)
def x1_axis_rotations(t: Tables):
    y = se3.rotation_y(F.get("e", F.lit(0)))
    z = se3.rotation_z(F.get("e", F.lit(1)))
    return t.vectors().select(
        "vec_id",
        r6(y[0][0]).alias("y00"),
        r6(y[0][2]).alias("y02"),
        r6(y[2][0]).alias("y20"),
        r6(z[0][1]).alias("z01"),
        r6(z[1][0]).alias("z10"),
    )


@query(
    "x2_adjoint",
    f"""SELECT vec_id, {q6(R["00"])} AS a00, 0.0::DOUBLE AS a03,
  {q6(f"-e[7]*({R['10']}) + e[6]*({R['20']})")} AS a30, {q6(f"e[7]*({R['01']}) - e[5]*({R['21']})")} AS a41,
  {q6(R["22"])} AS a55 FROM {QN}""",
)
def x2_adjoint(t: Tables):
    a = se3.adjoint(se3.cells(F.col("m"), 4, 4))
    return posed(t).select(
        "vec_id",
        r6(a[0][0]).alias("a00"),
        r6(a[0][3]).alias("a03"),
        r6(a[3][0]).alias("a30"),
        r6(a[4][1]).alias("a41"),
        r6(a[5][5]).alias("a55"),
    )


@query("x3_swap_halves", f"SELECT vec_id, {q6('e[4]')} AS s0, {q6('e[1]')} AS s3 FROM {VEC}")
def x3_swap_halves(t: Tables):
    s = se3.swap_halves(F.slice("e", 1, 6))
    return t.vectors().select(
        "vec_id", r6(F.get(s, F.lit(0))).alias("s0"), r6(F.get(s, F.lit(3))).alias("s3")
    )


@query(
    "x4_quaternion_to_rotation",
    f"""SELECT vec_id, {", ".join(f"{q6(v)} AS r{k}" for k, v in R.items())} FROM {QN}""",
)
def x4_quaternion_to_rotation(t: Tables):
    r = se3.quat_to_rotation([F.get("e", F.lit(i)) for i in range(4)])
    return t.vectors().select(
        "vec_id", *[r6(r[i][j]).alias(f"r{i}{j}") for i in range(3) for j in range(3)]
    )


# a rotation gives the quaternion back up to sign
SIGN = "CASE WHEN {trace} > 0 THEN sign(w) WHEN {xx} > {yy} AND {xx} > {zz} THEN sign(x) WHEN {yy} > {zz} THEN sign(y) ELSE sign(z) END".format(
    trace=f"(({R['00']}) + ({R['11']}) + ({R['22']}))",
    xx=f"({R['00']})",
    yy=f"({R['11']})",
    zz=f"({R['22']})",
)


@query(
    "x5_rotation_to_quaternion",
    f"""WITH s AS (SELECT *, {SIGN} AS s FROM {QN})
  SELECT vec_id, {", ".join(f"{q6(f's * {c}')} AS q{i}" for i, c in enumerate("wxyz"))} FROM s""",
)
def x5_rotation_to_quaternion(t: Tables):
    q = se3.rotation_to_quat(se3.rotation_of(se3.cells(F.col("m"), 4, 4)))
    return posed(t).withColumn("q", q).select("vec_id", *r_items(F.col("q"), 4, "q"))


@query(
    "x6_pose_to_matrix_and_back",
    f"""WITH s AS (SELECT *, {SIGN} AS s FROM {QN})
  SELECT vec_id, {q6("e[5]")} AS p0, {q6("e[7]")} AS p2, {q6("s * w")} AS p3, {q6("s * z")} AS p6,
    {q6(R["12"])} AS m12 FROM s""",
)
def x6_pose_to_matrix_and_back(t: Tables):
    p = se3.transform_to_pose7(se3.cells(F.col("m"), 4, 4))
    return posed(t).withColumn("p", p).select(
        "vec_id",
        *[r6(F.get("p", F.lit(i))).alias(f"p{i}") for i in (0, 2, 3, 6)],
        r6(cell(1, 2)).alias("m12"),
    )


@query(
    "x7_angles_to_quaternion",
    f"""WITH a AS (SELECT vec_id, radians(e[1] * 300) / 2 AS r, radians(e[2] * 300) / 2 AS p, radians(e[3] * 300) / 2 AS y FROM {VEC})
  SELECT vec_id, {q6("cos(r)*cos(p)*cos(y) + sin(r)*sin(p)*sin(y)")} AS q0,
    {q6("sin(r)*cos(p)*cos(y) - cos(r)*sin(p)*sin(y)")} AS q1, {q6("cos(r)*sin(p)*cos(y) + sin(r)*cos(p)*sin(y)")} AS q2,
    {q6("cos(r)*cos(p)*sin(y) - sin(r)*sin(p)*cos(y)")} AS q3 FROM a""",
)
def x7_angles_to_quaternion(t: Tables):
    q = se3.rpy_deg_to_quat(*[F.get("e", F.lit(i)) * 300 for i in range(3)])
    return t.vectors().select("vec_id", *[r6(x).alias(f"q{i}") for i, x in enumerate(q)])


@query(
    "x8_rotation_to_angles",
    f"""SELECT vec_id, {q6(f"degrees(atan2({R['21']}, {R['22']}))")} AS roll,
  {q6(f"degrees(asin(greatest(-1.0, least(1.0, -({R['20']})))))")} AS pitch,
  {q6(f"degrees(atan2({R['10']}, {R['00']}))")} AS yaw FROM {QN}""",
)
def x8_rotation_to_angles(t: Tables):
    a = se3.rotation_to_rpy_deg(se3.rotation_of(se3.cells(F.col("m"), 4, 4)))
    return posed(t).select(
        "vec_id", *[r6(x).alias(n) for x, n in zip(a, ("roll", "pitch", "yaw"))]
    )


@query(
    "x9_rotation_vector",
    f"""WITH a AS (SELECT vec_id, 2 * acos(least(1.0, abs(w))) AS th, sign(w) * x AS x, sign(w) * y AS y, sign(w) * z AS z FROM {QN})
  SELECT vec_id, {q6("x / sin(th / 2) * th")} AS v0, {q6("y / sin(th / 2) * th")} AS v1,
    {q6("degrees(z / sin(th / 2) * th)")} AS v2_deg FROM a""",
)
def x9_rotation_vector(t: Tables):
    r = se3.rotation_of(se3.cells(F.col("m"), 4, 4))
    v, d = se3.rotation_to_rotvec(r), se3.rotation_to_rotvec(r, degrees=True)
    return posed(t).select(
        "vec_id", r6(v[0]).alias("v0"), r6(v[1]).alias("v1"), r6(d[2]).alias("v2_deg")
    )


@query(
    "x10_validate_pose",
    f"""SELECT vec_id, CASE vec_id % 7 WHEN 1 THEN 'missing' WHEN 2 THEN 'not_4x4' WHEN 3 THEN 'not_finite'
  WHEN 4 THEN 'bottom_row' WHEN 5 THEN 'not_orthonormal' WHEN 6 THEN 'determinant' END AS reason FROM {VEC}""",
)
def x10_validate_pose(t: Tables):
    v = F.col("vec_id") % 7
    rows = [F.get("m", F.lit(i)) for i in range(4)]
    scale = [F.transform(r, lambda x: x * 1.01) for r in rows[:3]]
    mirrored = [F.transform(r, lambda x: -x) for r in rows[:3]]
    nan_row = F.transform(rows[1], lambda x: F.lit(float("nan")))
    m = (
        F.when(v == 1, F.lit(None).cast("array<array<double>>"))
        .when(v == 2, F.slice("m", 1, 3))
        .when(v == 3, F.array(rows[0], nan_row, rows[2], rows[3]))
        .when(v == 4, F.array(rows[0], rows[1], rows[2], rows[0]))
        .when(v == 5, F.array(*scale, rows[3]))
        .when(v == 6, F.array(*mirrored, rows[3]))
        .otherwise(F.col("m"))
    )
    staged = posed(t).select("vec_id", m.alias("m"))
    return staged.select("vec_id", se3.validate_se3(F.col("m"))["reason"].alias("reason"))


@query(
    "x11_tool_pose",
    f"""SELECT vec_id, {q6(f"e[5] + ({R['00']})*0.039711 + ({R['01']})*(-0.094423) + ({R['02']})*(-0.257957)")} AS x,
  {q6(f"e[6] + ({R['10']})*0.039711 + ({R['11']})*(-0.094423) + ({R['12']})*(-0.257957)")} AS y,
  {q6("abs(x)")} AS qw_abs FROM {QN}""",
)
def x11_tool_pose(t: Tables):
    """From a quaternion, composed with the mounting; its turn about x moves qx into qw."""
    xyz = [F.get("e", F.lit(i)) for i in (4, 5, 6)]
    staged = se3.with_source_pose(
        t.vectors(),
        "m",
        F.lit(None).cast("array<array<double>>"),
        xyz,
        F.slice("e", 1, 4),
        [F.lit(0.0)] * 3,
    )
    return se3.with_tool_pose7(staged, "p", "m").select(
        "vec_id",
        r6(F.get("p", F.lit(0))).alias("x"),
        r6(F.get("p", F.lit(1))).alias("y"),
        r6(F.abs(F.get("p", F.lit(3)))).alias("qw_abs"),
    )


@query(
    "x12_relative_pose",
    f"""SELECT vec_id, {q6(f"({R['00']})*(e[8]-e[5]) + ({R['10']})*(e[9]-e[6]) + ({R['20']})*(e[10]-e[7])")} AS dx,
  {q6(f"({R['02']})*(e[8]-e[5]) + ({R['12']})*(e[9]-e[6]) + ({R['22']})*(e[10]-e[7])")} AS dz,
  1.0::DOUBLE AS r00 FROM {QN}""",
)
def x12_relative_pose(t: Tables):
    """Relative to a pose of the same rotation at another place."""
    e = [F.get("e", F.lit(i)) for i in range(10)]
    other = se3.pack(se3.pose7_to_transform([*e[7:10], *e[:4]]))
    staged = posed(t).withColumn("o", other)
    rel = staged.withColumn("d", se3.relative_pose(F.col("m"), F.col("o")))
    return rel.select(
        "vec_id",
        r6(cell(0, 3, "d")).alias("dx"),
        r6(cell(2, 3, "d")).alias("dz"),
        r6(cell(0, 0, "d")).alias("r00"),
    )


# f' = R'f and m' = R'(m + f x p) for both fingers; width = |e[13]| / 10
TOOL = f"""(SELECT vec_id, e, 0.166 AS pz, 0.081 AS py, abs(e[13]) / 20 AS hw FROM {VEC})"""


@query(
    "x14_wrench_to_tool",
    f"""SELECT vec_id, {q6("e[3]")} AS lfx, {q6("e[2]")} AS lfy, {q6("-e[1]")} AS lfz,
  {q6("e[6] + (e[1]*(-py) - e[2]*pz)")} AS lmx, {q6("e[5] + (e[3]*pz - e[1]*hw)")} AS lmy,
  {q6("-(e[4] + (e[2]*hw - e[3]*(-py)))")} AS lmz,
  {q6("-e[9]")} AS rfx, {q6("-e[8]")} AS rfy, {q6("-e[7]")} AS rfz,
  {q6("-(e[12] + (e[7]*py - e[8]*pz))")} AS rmx FROM {TOOL}""",
)
def x14_wrench_to_tool(t: Tables):
    width = F.abs(F.get("e", F.lit(12))) / 10
    left = se3.wrench_to_tool("left", F.slice("e", 1, 6), width)
    right = se3.wrench_to_tool("right", F.slice("e", 7, 6), width)
    staged = t.vectors().withColumn("l", left).withColumn("r", right)
    return staged.select(
        "vec_id",
        *[r6(F.get("l", F.lit(i))).alias(n) for i, n in enumerate(("lfx", "lfy", "lfz", "lmx", "lmy", "lmz"))],
        *[r6(F.get("r", F.lit(i))).alias(n) for i, n in enumerate(("rfx", "rfy", "rfz", "rmx"))],
    )


@query(
    "x15_session_world",
    f"""WITH h AS (SELECT *, degrees(atan2({R["20"]}, {R["00"]})) AS h FROM {QN}),
  s AS (SELECT *, CASE WHEN h < 0 THEN -floor(-h / 90 + 0.5) ELSE floor(h / 90 + 0.5) END * 90 AS sn FROM h)
  SELECT vec_id, {q6("(sn + 360) % 360")} AS heading_deg, {q6("abs(h - sn)")} AS heading_error_deg,
    {q6(f"degrees(acos(-({R['12']})))")} AS tilt_error_deg,
    {q6("cos(radians(sn))*(e[8]-e[5]) + sin(radians(sn))*(e[10]-e[7])")} AS px, {q6("e[9]-e[6]")} AS pz FROM s""",
)
def x15_session_world(t: Tables):
    e = [F.get("e", F.lit(i)) for i in range(10)]
    other = se3.pack(se3.pose7_to_transform([*e[7:10], *e[:4]]))
    staged = posed(t).withColumn("o", other)
    out = staged.withColumn("s", se3.session_world(F.col("m"), F.col("o")))
    return out.select(
        "vec_id",
        r6("s.heading_deg").alias("heading_deg"),
        r6("s.heading_error_deg").alias("heading_error_deg"),
        r6("s.tilt_error_deg").alias("tilt_error_deg"),
        r6(cell(0, 3, "s.pose")).alias("px"),
        r6(cell(2, 3, "s.pose")).alias("pz"),
    )


REF = [[0.5 * (i == j) + 0.125 * ((i + j) % 2) for j in range(6)] for i in range(6)]


def _ref_sql(i: int) -> str:
    return "(" + " + ".join(f"(e[{j + 1}] - e[{j + 7}]) * {REF[i][j]}::DOUBLE" for j in range(6)) + ")"


@query(
    "x19_reference_wrench",
    f"""SELECT vec_id, {q6(_ref_sql(0))} AS fx, {q6(f"{_ref_sql(3)} + {_ref_sql(1)} * 0.05")} AS mx,
  {q6(f"{_ref_sql(4)} - {_ref_sql(0)} * 0.05")} AS my FROM {VEC}""",
)
def x19_reference_wrench(t: Tables):
    w = se3.reference_wrench(F.slice("e", 1, 6), F.slice("e", 7, 6), REF, 0.05)
    return t.vectors().withColumn("w", w).select(
        "vec_id", *[r6(F.get("w", F.lit(i))).alias(n) for i, n in ((0, "fx"), (3, "mx"), (4, "my"))]
    )


@query("x20_residual_label", f"SELECT vec_id, {q6('e[1] - e[7]')} AS d0, {q6('e[6] - e[12]')} AS d5 FROM {VEC}")
def x20_residual_label(t: Tables):
    d = se3.residual(F.slice("e", 1, 6), F.slice("e", 7, 6))
    return t.vectors().select(
        "vec_id", r6(F.get(d, F.lit(0))).alias("d0"), r6(F.get(d, F.lit(5))).alias("d5")
    )
