"""Queries: equi joins, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from braidline import asof
from braidline.functions import se3
from braidline.operators import filters, relations
from braidline.queries.base import EV, HOUR, VEC, Tables, q6, query, r6, stamp, stamp_sql

KEYS = ["user_id"]

# orders are video frames (sequence = order key), their lineitems the metadata
FRAMES = "(SELECT o_orderkey AS seq, o_custkey % 100 AS session, epoch_us(o_orderdate) * 1000 AS capture_ns FROM orders)"
META = """(SELECT seq, session, capture_ns + CASE WHEN seq % 97 = 0 THEN 1 ELSE 0 END AS capture_ns
  FROM {f} WHERE seq % 89 <> 0 UNION ALL SELECT seq + 1000000000, session, capture_ns FROM {f}
  WHERE seq % 83 = 0)""".format(f=FRAMES)


def frames(t: Tables):
    return t.orders().select(
        F.col("o_orderkey").alias("seq"),
        (F.col("o_custkey") % 100).alias("session"),
        F.col("t").alias("capture_ns"),
    )


def metadata(t: Tables):
    f = frames(t)
    shifted = F.when(F.col("seq") % 97 == 0, F.col("capture_ns") + 1).otherwise(F.col("capture_ns"))
    stray = f.where(F.col("seq") % 83 == 0).select(
        (F.col("seq") + 1_000_000_000).alias("seq"), "session", "capture_ns"
    )
    return f.where(F.col("seq") % 89 != 0).select(
        "seq", "session", shifted.alias("capture_ns")
    ).unionByName(stray)


J6 = f"""j AS (SELECT coalesce(f.session, m.session) AS session, coalesce(f.seq, m.seq) AS seq,
  f.capture_ns, CASE WHEN m.seq IS NULL THEN 'missing_metadata' WHEN f.seq IS NULL
  THEN 'missing_frame' WHEN f.capture_ns <> m.capture_ns THEN 'timestamp_mismatch' END AS violation
  FROM {FRAMES} f FULL JOIN {META} m ON f.session = m.session AND f.seq = m.seq)"""


@query(
    "j6_frames_with_metadata",
    f"WITH {J6} SELECT session, seq, capture_ns FROM j WHERE violation IS NULL",
)
def j6_frames_with_metadata(t: Tables):
    good, _ = relations.frames_with_metadata(frames(t), metadata(t), ["session", "seq"])
    return good.select("session", "seq", "capture_ns")


@query(
    "j6_frame_violations",
    f"WITH {J6} SELECT session, seq, violation FROM j WHERE violation IS NOT NULL",
)
def j6_frame_violations(t: Tables):
    _, bad = relations.frames_with_metadata(frames(t), metadata(t), ["session", "seq"])
    return bad


# lineitems are depth rows: many per order, the last one wins
DEPTH_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(
    "j7_optional_depth",
    f"""WITH d AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC,
    l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS k FROM lineitem WHERE l_quantity > 30)
  SELECT o_orderkey AS seq, l_partkey, d.l_orderkey IS NOT NULL AS depth_valid
  FROM orders LEFT JOIN d ON o_orderkey = l_orderkey AND k = 1""",
)
def j7_optional_depth(t: Tables):
    depth = t.table("lineitem").where(F.col("l_quantity") > 30)
    out = relations.with_optional(
        frames(t),
        depth.select(
            F.col("l_orderkey").alias("seq"),
            *[c.strip() for c in DEPTH_ORDER.split(",")],
        ),
        ["seq"],
        [c.strip() for c in DEPTH_ORDER.split(",")],
        "depth_valid",
    )
    return out.select("seq", "l_partkey", "depth_valid")


@query(
    "j8_events_with_timing",
    f"""SELECT l.l_partkey AS part, l.l_orderkey AS seq, f.capture_ns FROM lineitem l
  JOIN {FRAMES} f ON l.l_orderkey = f.seq WHERE l.l_returnflag = 'R'""",
)
def j8_events_with_timing(t: Tables):
    marks = (
        t.table("lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(F.col("l_partkey").alias("part"), F.col("l_orderkey").alias("seq"))
    )
    return relations.events_with_timing(marks, frames(t), ["seq"]).select(
        "part", "seq", "capture_ns"
    )


@query(
    "j10_fused_sensors",
    f"""WITH l AS (SELECT * FROM {EV} WHERE event_type = 'purchase'),
  r AS (SELECT * FROM {EV} WHERE event_type = 'click'),
  n AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS nl,
    count(*) FILTER (event_type = 'click') AS nr FROM {EV} GROUP BY 1 HAVING nl > 0 AND nr > 0),
  x AS (SELECT e.user_id, e.t, e.event_id FROM {EV} e JOIN n USING (user_id) WHERE event_type =
    CASE WHEN nl <= nr THEN 'purchase' ELSE 'click' END),
  j AS (SELECT x.*, lb.t AS lbt, lb.value AS lbv, la.t AS lat, la.value AS lav,
      rb.t AS rbt, rb.value AS rbv, ra.t AS rat, ra.value AS rav
    FROM x ASOF LEFT JOIN l lb ON x.user_id = lb.user_id AND x.t >= lb.t
      ASOF LEFT JOIN l la ON x.user_id = la.user_id AND x.t <= la.t
      ASOF LEFT JOIN r rb ON x.user_id = rb.user_id AND x.t >= rb.t
      ASOF LEFT JOIN r ra ON x.user_id = ra.user_id AND x.t <= ra.t)
  SELECT event_id, {q6('''0.5 * (
    CASE WHEN lbt IS NULL THEN lav WHEN lat IS NULL OR lat = lbt THEN lbv
      ELSE lbv + (lav - lbv) * ((t - lbt)::DOUBLE / (lat - lbt)) END +
    CASE WHEN rbt IS NULL THEN rav WHEN rat IS NULL OR rat = rbt THEN rbv
      ELSE rbv + (rav - rbv) * ((t - rbt)::DOUBLE / (rat - rbt)) END)''')} AS force FROM j""",
)
def j10_fused_sensors(t: Tables):
    left = asof.Stream(t.events("purchase"), "t", "event_id")
    right = asof.Stream(t.events("click"), "t", "event_id")
    out = relations.fused_sensors(left, right, KEYS, ["value"])
    return out.select(F.col("seq").alias("event_id"), r6("value").alias("force"))


@query(
    "j11_preferred_samples",
    f"""WITH p AS (SELECT user_id, event_id FROM {EV} WHERE event_type = 'purchase' AND value > 80),
  r AS (SELECT user_id, event_id FROM {EV} WHERE event_type = 'purchase')
  SELECT *, 'timeline' AS source FROM p UNION ALL
  SELECT *, 'raw' FROM r WHERE user_id NOT IN (SELECT user_id FROM p)""",
)
def j11_preferred_samples(t: Tables):
    raw = t.events("purchase")
    good = raw.where(F.col("value") > 80).select("user_id", "event_id")
    return relations.preferred_samples(good, raw.select("user_id", "event_id"), KEYS)


@query(
    "j12_parameters_by_side",
    f"""WITH p AS (SELECT event_type AS side, avg(value) AS mu, stddev_pop(value) AS sd FROM {EV} GROUP BY 1)
  SELECT event_id, {q6("(value - mu) / sd")} AS z FROM {EV} JOIN p ON event_type = side""",
)
def j12_parameters_by_side(t: Tables):
    rows = t.events().withColumnRenamed("event_type", "side")
    parameters = rows.groupBy("side").agg(
        F.avg("value").alias("mu"), F.stddev_pop("value").alias("sd")
    )
    out = relations.with_parameters(rows, parameters, ["side"])
    return out.select("event_id", r6((F.col("value") - F.col("mu")) / F.col("sd")).alias("z"))


RESPONSES = f"""r AS (SELECT event_id + CASE WHEN event_id % 50 = 0 THEN 1000000000 ELSE 0 END
  AS request_id, t + CASE WHEN event_id % 31 = 0 THEN 5 ELSE 0 END AS t1_ns FROM {EV}),
  j AS (SELECT r.request_id, r.t1_ns, CASE WHEN q.event_id IS NULL THEN 'unknown_request_id'
    WHEN q.t <> r.t1_ns THEN 'changed_send_time' END AS violation
    FROM r LEFT JOIN {EV} q ON r.request_id = q.event_id)"""


def _exchanges(t: Tables):
    e = F.col("event_id")
    requests = t.events().select(e.alias("request_id"), F.col("t").alias("t1_ns"))
    responses = t.events().select(
        F.when(e % 50 == 0, e + 1_000_000_000).otherwise(e).alias("request_id"),
        F.when(e % 31 == 0, F.col("t") + 5).otherwise(F.col("t")).alias("t1_ns"),
    )
    return relations.clock_exchanges(requests, responses, ["request_id"])


@query(
    "j13_clock_exchanges",
    f"WITH {RESPONSES} SELECT request_id, t1_ns FROM j WHERE violation IS NULL",
)
def j13_clock_exchanges(t: Tables):
    return _exchanges(t)[0].select("request_id", "t1_ns")


@query(
    "j13_exchange_violations",
    f"WITH {RESPONSES} SELECT request_id, violation FROM j WHERE violation IS NOT NULL",
)
def j13_exchange_violations(t: Tables):
    return _exchanges(t)[1]


def assembled(t: Tables):
    e = t.events()
    video = e.select("user_id", F.col("event_id").alias("seq"))
    meta = e.where(F.col("event_id") % 41 != 0).select(
        "user_id", F.col("event_id").alias("seq"), (F.col("value") > 20).alias("depth_expected")
    )
    depth = e.where(F.col("value") > 25).select(
        "user_id", F.col("event_id").alias("seq"), F.col("value").alias("center_m")
    )
    depth = depth.unionByName(
        e.where((F.col("value") < 20) & (F.col("event_id") % 7 == 0)).select(
            "user_id", F.col("event_id").alias("seq"), F.col("value").alias("center_m")
        )
    )
    marks = t.events("signup", "error").select("user_id", F.col("event_id").alias("seq"))
    return relations.assemble_frames(video, meta, depth, marks, ["user_id", "seq"])


@query(
    "j14_frame_assembly",
    f"""SELECT event_id AS seq, CASE WHEN event_id % 41 = 0 THEN 'missing_metadata'
    WHEN value > 20 AND value <= 25 THEN 'missing_depth'
    WHEN value < 20 AND event_id % 7 = 0 THEN 'unexpected_depth' END AS violation,
    CASE WHEN event_type IN ('signup', 'error') THEN 1 ELSE 0 END::BIGINT AS event_count FROM {EV}""",
)
def j14_frame_assembly(t: Tables):
    return assembled(t).select("seq", "violation", "event_count")


SEGMENTS = """{n} AS (SELECT user_id, t, event_id, value, event_id % 3 = 0 AS lvl FROM {ev}
    WHERE event_type IN ({kinds})),
  {n}e AS (SELECT *, CASE WHEN lag(lvl) OVER w <> lvl THEN 1 ELSE 0 END AS edge FROM {n}
    WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
  {n}s AS (SELECT *, sum(edge) OVER (PARTITION BY user_id ORDER BY t, event_id) AS seg FROM {n}e),
  {n}m AS (SELECT user_id, seg::BIGINT AS seg, avg(value) AS v FROM {n}s GROUP BY 1, 2)"""


@query(
    "j15_paired_pulses",
    f"""WITH {SEGMENTS.format(n="ka", ev=EV, kinds="'click', 'view'")},
  {SEGMENTS.format(n="kb", ev=EV, kinds="'purchase', 'error'")},
  l AS (SELECT kam.user_id, least(max(kam.seg), any_value(bx.m)) AS last FROM kam JOIN
    (SELECT user_id, max(seg) AS m FROM kbm GROUP BY 1) bx USING (user_id) GROUP BY 1)
  SELECT user_id, seg AS segment, {q6("kam.v")} AS a_value, {q6("kbm.v")} AS b_value
  FROM kam JOIN kbm USING (user_id, seg) JOIN l USING (user_id) WHERE seg >= 2 AND seg < last""",
)
def j15_paired_pulses(t: Tables):
    def means(*kinds):
        rows = t.events(*kinds).withColumn("level", F.col("event_id") % 3 == 0)
        return relations.pulse_means(rows, KEYS, ["t", "event_id"], "level", ["value"])

    out = relations.paired_pulses(
        means("click", "view"), means("purchase", "error"), KEYS, ["value"]
    )
    return out.select("user_id", "segment", r6("a_value").alias("a_value"), r6("b_value").alias("b_value"))


@query(
    "j16_conflicting_payloads",
    """SELECT conv_id, count(DISTINCT md5(text)) AS variants FROM conversations
  GROUP BY 1 HAVING count(DISTINCT md5(text)) > 1""",
)
def j16_conflicting_payloads(t: Tables):
    return relations.conflicting_payloads(t.conversations(), ["conv_id"], "text")


@query(
    "j17_episode_catalog",
    f"""WITH l AS (SELECT user_id AS ep, min(event_id) AS source, max(t) AS stop FROM {EV} GROUP BY 1),
  m AS (SELECT user_id AS ep, min(event_id) + 1 AS source, max(t) AS stop FROM {EV}
    WHERE event_type = 'view' AND value > 30 GROUP BY 1)
  SELECT l.ep, coalesce(m.source, l.source) AS source, coalesce(m.stop, l.stop) AS stop
  FROM l LEFT JOIN m USING (ep)""",
)
def j17_episode_catalog(t: Tables):
    def shaped(df, shift):
        return df.groupBy(F.col("user_id").alias("ep")).agg(
            (F.min("event_id") + shift).alias("source"), F.max("t").alias("stop")
        )

    return relations.episode_catalog(
        shaped(t.events(), 0),
        shaped(t.events("view").where(F.col("value") > 30), 1),
        "ep",
        ["source", "stop"],
    )


@query(
    "f1_time_window",
    f"""SELECT e.event_id FROM {EV} e JOIN (SELECT user_id, min(t) + {24 * HOUR} AS s,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE max(t) - {24 * HOUR} END AS x FROM {EV} GROUP BY user_id) w
    ON e.user_id = w.user_id AND e.t >= s AND (x IS NULL OR e.t <= x)""",
)
def f1_time_window(t: Tables):
    rows = t.events()
    w = rows.groupBy("user_id").agg(
        (F.min("t") + 24 * HOUR).alias("s"),
        F.when(F.col("user_id") % 3 != 0, F.max("t") - 24 * HOUR).alias("x"),
    )
    keep = filters.in_window(F.col("t"), F.col("s"), F.col("x"))
    return rows.join(w, "user_id").where(keep).select("event_id")


def exportable_rows(t: Tables):
    """Timeline rows with image and pose structs made from the events."""
    e = F.col("event_id")
    return t.events().select(
        "event_id",
        "value",
        F.when(e % 5 > 0, e % 7 != 1).alias("phone_ok"),
        F.when(e % 6 > 0, e % 11 != 1).alias("camera_ok"),
        (e % 13 != 1).alias("force_ok"),
        F.struct(
            F.when(e % 4 > 0, F.lit(True)).alias("valid"),
            F.when(e % 17 != 2, "h264").otherwise("jpeg").alias("codec"),
            F.when(e % 19 != 3, F.concat(F.lit("v/"), e.cast("string"))).alias("video_path"),
            F.when(e % 23 != 4, e).alias("frame_index"),
        ).alias("rgb"),
        F.struct(
            (e % 3 != 0).alias("valid"),
            F.when(e % 29 != 5, F.lit(True)).alias("world_calibrated"),
            F.when(e % 31 != 6, "user_world").otherwise("unavailable").alias("frame"),
        ).alias("pose"),
    )


POSE_OK = "(event_id % 3 <> 0 AND event_id % 29 <> 5 AND event_id % 31 <> 6)"
PHONE_OK = "(event_id % 5 = 0 OR event_id % 7 <> 1)"
STRICT = "(event_id % 5 > 0 AND event_id % 7 <> 1 AND event_id % 6 > 0 AND event_id % 11 <> 1 AND event_id % 13 <> 1)"


@query(
    "f2_exportable_rows",
    f"""SELECT event_id FROM {EV} WHERE {PHONE_OK} AND event_id % 17 <> 2 AND event_id % 19 <> 3
  AND event_id % 23 <> 4 AND {POSE_OK}""",
)
def f2_exportable_rows(t: Tables):
    keep = filters.exportable(F.col("phone_ok"), F.col("rgb"), F.col("pose"))
    return exportable_rows(t).where(keep).select("event_id")


@query("f3_strictly_exportable", f"SELECT event_id FROM {EV} WHERE {STRICT} AND {POSE_OK}")
def f3_strictly_exportable(t: Tables):
    flags = [F.col(c) for c in ("phone_ok", "camera_ok", "force_ok")]
    keep = filters.strictly_exportable(flags, F.col("pose"))
    return exportable_rows(t).where(keep).select("event_id")


@query("f4_all_streams_valid", f"SELECT event_id FROM {EV} WHERE {STRICT}")
def f4_all_streams_valid(t: Tables):
    flags = [F.col(c) for c in ("phone_ok", "camera_ok", "force_ok")]
    return exportable_rows(t).where(filters.all_streams_valid(*flags)).select("event_id")


@query(
    "f5_dual_wrench",
    f"""SELECT vec_id, {q6("CASE WHEN vec_id % 3 = 0 THEN e[1] WHEN vec_id % 5 = 0 THEN NULL ELSE e[13] END")} AS left_fx,
    {q6("CASE WHEN vec_id % 3 = 0 THEN e[7] WHEN vec_id % 5 = 0 THEN NULL ELSE e[19] END")} AS right_fx FROM {VEC}""",
)
def f5_dual_wrench(t: Tables):
    v = F.col("vec_id")
    e = F.col("e")
    combined = F.when(v % 3 == 0, F.array(F.slice(e, 1, 6), F.slice(e, 7, 6))).otherwise(
        F.array(F.slice(e, 1, 6), F.slice(e, 7, 5))
    )
    broken = F.concat(F.slice(e, 13, 5), F.array(F.lit(float("nan"))))
    left = F.when(v % 5 == 0, broken).otherwise(F.slice(e, 13, 6))
    pair = filters.dual_wrench(combined, left, F.slice(e, 19, 6))
    return t.vectors().select("vec_id", pair.alias("p")).select(
        "vec_id",
        r6(F.get(F.get("p", F.lit(0)), F.lit(0))).alias("left_fx"),
        r6(F.get(F.get("p", F.lit(1)), F.lit(0))).alias("right_fx"),
    )


@query(
    "f6_calibration_accepted",
    f"""SELECT event_id FROM {EV} WHERE event_type IN ('view', 'click')
  AND (event_id % 3 = 0 OR event_id % 5 <> 1)""",
)
def f6_calibration_accepted(t: Tables):
    e = F.col("event_id")
    status = F.when(F.col("event_type") == "view", "ok").when(
        F.col("event_type") != "click", F.lit("tare_pending")
    )
    flag = F.when(e % 3 != 0, e % 5 != 1)
    return t.events().where(filters.calibration_accepted(status, flag)).select("event_id")


@query(
    "f7_without_excluded",
    f"SELECT event_id, user_id FROM {EV} WHERE user_id % 17 <> 0 OR user_id NOT IN (SELECT user_id FROM {EV} WHERE event_type = 'error')",
)
def f7_without_excluded(t: Tables):
    banned = t.events("error").where(F.col("user_id") % 17 == 0).select("user_id")
    return filters.without_excluded(t.events(), banned, "user_id").select("event_id", "user_id")


@query(
    "f8_register_exclusions",
    f"""WITH x AS (SELECT DISTINCT user_id AS session, user_id + 5000 AS source FROM {EV} WHERE user_id % 17 = 0),
  w AS (SELECT DISTINCT CASE WHEN user_id % 4 = 1 THEN NULL ELSE user_id END AS session,
    CASE WHEN user_id % 4 = 2 THEN NULL ELSE user_id + 5000 END AS source FROM {EV} WHERE user_id % 3 = 0)
  SELECT * FROM x UNION ALL SELECT * FROM w
    WHERE (session IS NOT NULL OR source IS NOT NULL)
      AND NOT coalesce(session IN (SELECT session FROM x), false)
      AND NOT coalesce(source IN (SELECT source FROM x), false)""",
)
def f8_register_exclusions(t: Tables):
    u = F.col("user_id")
    users = t.events().select("user_id").distinct()
    existing = users.where(u % 17 == 0).select(u.alias("session"), (u + 5000).alias("source"))
    wanted = users.where(u % 3 == 0).select(
        F.when(u % 4 != 1, u).alias("session"), F.when(u % 4 != 2, u + 5000).alias("source")
    )
    return filters.register_exclusions(existing, wanted, "session", "source")


@query(
    "f9_effective_rows",
    f"""SELECT event_id FROM {EV} e JOIN (SELECT user_id, min(t) + {72 * HOUR} AS s,
    max(t) - {72 * HOUR} AS x FROM {EV} GROUP BY 1) w USING (user_id) WHERE t BETWEEN s AND x""",
)
def f9_effective_rows(t: Tables):
    rows = t.events()
    ends = rows.groupBy("user_id").agg(
        (F.min("t") + 72 * HOUR).alias("s"), (F.max("t") - 72 * HOUR).alias("x")
    )
    return filters.effective_rows(rows.join(ends, "user_id"), "t", "s", "x").select("event_id")


def marker_rows(t: Tables):
    """Two markers on short straight paths, seen at places made from the event values."""
    e = F.col("event_id")
    return t.events().select(
        "event_id",
        "user_id",
        "t",
        (e % 2).cast("int").alias("marker"),
        (F.lit(300.0) + (F.col("value") * 7) % 300).alias("x"),
        (F.lit(200.0) + (F.col("value") * 13) % 40).alias("y"),
        F.lit(800.0).alias("width"),
    )


def marker_paths(t: Tables):
    """One path per marker, from the same table."""
    m = (F.col("event_id") % 2).cast("int").alias("marker")
    return (
        t.events()
        .groupBy(m)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "marker",
            F.lit(300.0).alias("ax"),
            F.lit(210.0).alias("ay"),
            (F.lit(500.0) + F.col("marker") * 100).alias("bx"),
            F.lit(210.0).alias("by"),
        )
    )


@query(
    "f10_marker_path_filter",
    f"""WITH m AS (SELECT event_id, event_id % 2 AS marker, 300.0 + (value * 7) % 300 AS x,
    200.0 + (value * 13) % 40 AS y FROM {EV}),
  p AS (SELECT *, 200.0 + marker * 100 AS len FROM m),
  q AS (SELECT *, greatest(0.0, least(1.0, (x - 300.0) / len)) AS u FROM p),
  r AS (SELECT *, sqrt((x - (300.0 + u * len)) ** 2 + (y - 210.0) ** 2) AS err FROM q)
  SELECT event_id, {q6("u * 100")} AS percent FROM r WHERE CASE WHEN marker = 0 THEN x <= 800.0 * 2 / 3
    ELSE x >= 400.0 END AND err <= CASE WHEN marker = 0 THEN greatest(20.0, len * 0.16)
    ELSE greatest(32.0, len * 0.24) END""",
)
def f10_marker_path_filter(t: Tables):
    out = filters.on_path(marker_rows(t), marker_paths(t), "marker", "x", "y", "width")
    return out.select("event_id", r6("percent").alias("percent"))


F10_SQL = f"""WITH RECURSIVE r AS (SELECT event_id, user_id, t, (value * 3) % 100 AS p,
      row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM {EV}),
  s AS (SELECT user_id, k, event_id, p, true AS ok, t AS lt, p AS lp FROM r WHERE k = 1
    UNION ALL SELECT user_id, k, event_id, p, ok, CASE WHEN ok THEN t ELSE lt END, CASE WHEN ok THEN p ELSE lp END FROM
      (SELECT r.*, s.lt, s.lp, (r.t - s.lt) / {100 * HOUR} > 0.22
        OR abs(r.p - s.lp) <= 28.0 + (r.t - s.lt) / {100 * HOUR} * 520.0 AS ok
       FROM s JOIN r ON r.user_id = s.user_id AND r.k = s.k + 1))
  SELECT event_id, user_id, {stamp_sql("event_id")} AS stamp, {q6("p")} AS percent FROM s WHERE ok"""


def _jumps(t: Tables, rows_per_task: int | None = None):
    rows = t.events().withColumn("percent", (F.col("value") * 3) % 100)
    return filters.reject_jumps(
        rows.withColumn("stamp", stamp("event_id")), KEYS, "t", "percent", "event_id",
        second=100 * HOUR, rows_per_task=rows_per_task,
    ).select("event_id", "user_id", "stamp", r6("percent").alias("percent"))


@query("f10_jump_filter", F10_SQL)
def f10_jump_filter(t: Tables):
    """Tracker samples that do not jump; the guard time is 22 hours of events."""
    return _jumps(t)


@query("f10_jump_filter_cut_keys", F10_SQL)
def f10_jump_filter_cut_keys(t: Tables):
    return _jumps(t, rows_per_task=30)


@query(
    "x13_segment_projection",
    f"""WITH m AS (SELECT vec_id, e[1] AS px, e[2] AS py, e[3] AS ax, e[4] AS ay, e[5] AS qx, e[6] AS qy FROM {VEC}),
  q AS (SELECT *, (qx - ax) ** 2 + (qy - ay) ** 2 AS l2 FROM m),
  u AS (SELECT *, greatest(0.0, least(1.0, ((px - ax) * (qx - ax) + (py - ay) * (qy - ay)) / l2)) AS u FROM q)
  SELECT vec_id, {q6("u")} AS u, {q6("sqrt((px - (ax + u * (qx - ax))) ** 2 + (py - (ay + u * (qy - ay))) ** 2)")} AS err,
    {q6("sqrt(l2)")} AS len, {q6("sqrt((qx - px) ** 2 + (qy - py) ** 2)")} AS dist, {q6("ax + (qx - ax) * u")} AS mx FROM u""",
)
def x13_segment_projection(t: Tables):
    px, py, ax, ay, bx, by = (F.get("e", F.lit(i)) for i in range(6))
    p = se3.project_on_segment(px, py, ax, ay, bx, by)
    staged = t.vectors().withColumn("p", p)
    mx, _ = se3.point_between(ax, ay, bx, by, F.col("p.t"))
    return staged.select(
        "vec_id",
        r6("p.t").alias("u"),
        r6("p.error").alias("err"),
        r6("p.length").alias("len"),
        r6(se3.point_distance(px, py, bx, by)).alias("dist"),
        r6(mx).alias("mx"),
    )
