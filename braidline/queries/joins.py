"""Queries: alignment and join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from braidline import asof
from braidline.plans import alignment
from braidline.queries.base import DAY, EV, HOUR, Tables, q6, query, r6

KEYS = ["user_id"]

# nearest click and bracketing purchases of every view, in SQL
NEAR_SQL = f"""
v AS (SELECT * FROM {EV} WHERE event_type = 'view'),
c AS (SELECT * FROM {EV} WHERE event_type = 'click'),
p AS (SELECT * FROM {EV} WHERE event_type = 'purchase'),
cb AS (SELECT v.event_id, c.event_id AS id, c.t AS at, c.value AS val FROM v ASOF LEFT JOIN c
       ON v.user_id = c.user_id AND v.t >= c.t),
ca AS (SELECT v.event_id, c.event_id AS id, c.t AS at, c.value AS val FROM v ASOF LEFT JOIN c
       ON v.user_id = c.user_id AND v.t <= c.t),
pb AS (SELECT v.event_id, p.event_id AS id, p.t AS at, p.value AS val FROM v ASOF LEFT JOIN p
       ON v.user_id = p.user_id AND v.t >= p.t),
pa AS (SELECT v.event_id, p.event_id AS id, p.t AS at, p.value AS val FROM v ASOF LEFT JOIN p
       ON v.user_id = p.user_id AND v.t <= p.t)"""


def streams(t: Tables):
    views = t.events("view").select("event_id", "user_id", "t", "value")
    clicks = t.events("click").select("event_id", "user_id", "t", "value")
    purchases = t.events("purchase").select(
        "event_id",
        "user_id",
        "t",
        "value",
        F.array("value", F.col("value") * 2).alias("left_wrench"),
        F.array(-F.col("value"), F.col("value") + 1).alias("right_wrench"),
    )
    return (
        views,
        asof.Stream(clicks, "t", "event_id"),
        asof.Stream(purchases, "t", "event_id"),
    )


def timeline(t: Tables, rows_per_task: int | None = None):
    views, clicks, purchases = streams(t)
    return alignment.align(
        views,
        clicks,
        purchases,
        KEYS,
        "t",
        "event_id",
        camera_max_ms=6 * HOUR / 1e6,
        force_max_ms=36 * HOUR / 1e6,
        rows_per_task=rows_per_task,
    )


def _timeline_out(df):
    return df.select(
        "event_id",
        "user_id",
        "t",
        F.col("camera.valid").alias("camera_valid"),
        r6("camera.source_delta_ms").alias("camera_delta_ms"),
        F.col("camera.dropped_reason").alias("camera_reason"),
        F.col("camera.row.event_id").alias("camera_id"),
        F.col("force.valid").alias("force_valid"),
        r6("force.source_delta_ms").alias("force_delta_ms"),
        F.col("force.dropped_reason").alias("force_reason"),
        r6("force.alpha").alias("alpha"),
        r6(F.get("force.left_wrench", F.lit(0))).alias("left0"),
        r6(F.get("force.right_wrench", F.lit(1))).alias("right1"),
        "all_valid",
    )


TIMELINE_CTE = f"""WITH {NEAR_SQL},
j AS (SELECT v.event_id, v.user_id, v.t,
  CASE WHEN cb.at IS NULL THEN ca.id WHEN ca.at IS NULL THEN cb.id
       WHEN v.t - cb.at < ca.at - v.t THEN cb.id ELSE ca.id END AS camera_id,
  CASE WHEN cb.at IS NULL THEN ca.at WHEN ca.at IS NULL THEN cb.at
       WHEN v.t - cb.at < ca.at - v.t THEN cb.at ELSE ca.at END - v.t AS cd,
  pb.at AS bt, pa.at AS xt, pb.val AS bv, pa.val AS av
  FROM v LEFT JOIN cb USING (event_id) LEFT JOIN ca USING (event_id)
         LEFT JOIN pb USING (event_id) LEFT JOIN pa USING (event_id)),
k AS (SELECT *, cd IS NOT NULL AND abs(cd) <= {6 * HOUR} AS cv,
  bt IS NOT NULL AND xt IS NOT NULL AND xt - bt <= {36 * HOUR} AS fv,
  CASE WHEN xt = bt THEN 0.0::DOUBLE ELSE (t - bt)::DOUBLE / (xt - bt) END AS al FROM j),
tl AS (SELECT event_id, user_id, t, cv AS camera_valid, {q6("cd / 1e6")} AS camera_delta_ms,
  CASE WHEN cd IS NULL THEN 'missing_stream' WHEN NOT cv
       THEN 'nearest_sample_outside_threshold' END AS camera_reason,
  camera_id, fv AS force_valid,
  {q6("CASE WHEN bt IS NULL OR xt IS NULL THEN NULL WHEN t - bt <= xt - t THEN bt - t ELSE xt - t END / 1e6")} AS force_delta_ms,
  CASE WHEN bt IS NULL OR xt IS NULL THEN 'missing_bracketing_samples'
       WHEN NOT fv THEN 'bracketing_gap_outside_threshold' END AS force_reason,
  CASE WHEN fv THEN {q6("al")} END AS alpha,
  CASE WHEN fv THEN {q6("bv + (av - bv) * al")} END AS left0,
  CASE WHEN fv THEN {q6("(bv + 1) + ((av + 1) - (bv + 1)) * al")} END AS right1,
  cv AND fv AS all_valid FROM k)"""


@query("align_timeline", f"{TIMELINE_CTE} SELECT * FROM tl")
def align_timeline(t: Tables):
    return _timeline_out(timeline(t))


@query("align_timeline_cut_keys", f"{TIMELINE_CTE} SELECT * FROM tl")
def align_timeline_cut_keys(t: Tables):
    """The same timeline with every large key cut into pieces."""
    return _timeline_out(timeline(t, rows_per_task=40))


@query(
    "j1_nearest",
    f"""WITH {NEAR_SQL} SELECT v.event_id,
  CASE WHEN cb.at IS NULL THEN ca.id WHEN ca.at IS NULL THEN cb.id
       WHEN v.t - cb.at < ca.at - v.t THEN cb.id ELSE ca.id END AS near_id,
  CASE WHEN cb.at IS NULL THEN ca.at WHEN ca.at IS NULL THEN cb.at
       WHEN v.t - cb.at < ca.at - v.t THEN cb.at ELSE ca.at END - v.t AS delta
  FROM v LEFT JOIN cb USING (event_id) LEFT JOIN ca USING (event_id)""",
)
def j1_nearest(t: Tables):
    views, clicks, _ = streams(t)
    near = asof.nearest_join(views, clicks, KEYS, "t", "event_id")
    return near.select(
        "event_id", F.col("near.event_id").alias("near_id"), F.col("near_delta").alias("delta")
    )


@query(
    "j2_nearest_earlier_tie",
    f"""WITH {NEAR_SQL} SELECT v.event_id,
  CASE WHEN cb.at IS NULL THEN ca.id WHEN ca.at IS NULL THEN cb.id
       WHEN v.t - cb.at <= ca.at - v.t THEN cb.id ELSE ca.id END AS near_id,
  v.t - CASE WHEN cb.at IS NULL THEN ca.at WHEN ca.at IS NULL THEN cb.at
       WHEN v.t - cb.at <= ca.at - v.t THEN cb.at ELSE ca.at END AS age
  FROM v LEFT JOIN cb USING (event_id) LEFT JOIN ca USING (event_id)""",
)
def j2_nearest_earlier_tie(t: Tables):
    views, clicks, _ = streams(t)
    near = asof.nearest_join(views, clicks, KEYS, "t", "event_id", tie="before")
    return near.select(
        "event_id",
        F.col("near.event_id").alias("near_id"),
        (-F.col("near_delta")).alias("age"),
    )


@query(
    "j3_bracket",
    f"""WITH {NEAR_SQL} SELECT v.event_id, pb.id AS before_id, pa.id AS after_id
  FROM v LEFT JOIN pb USING (event_id) LEFT JOIN pa USING (event_id)""",
)
def j3_bracket(t: Tables):
    views, _, purchases = streams(t)
    both = asof.bracket_join(views, {"p": purchases}, KEYS, "t", "event_id")
    before, after = asof.bracket("p", "t")
    return both.select(
        "event_id",
        before["event_id"].alias("before_id"),
        after["event_id"].alias("after_id"),
    )


@query(
    "j4_bracket_interpolation",
    f"""{TIMELINE_CTE} SELECT event_id, force_valid, force_reason, alpha, left0, right1 FROM tl""",
)
def j4_bracket_interpolation(t: Tables):
    views, _, purchases = streams(t)
    both = asof.bracket_join(views, {"p": purchases}, KEYS, "t", "event_id")
    before, after = asof.bracket("p", "t")
    f = alignment.interpolated_payload(
        F.col("_b"), F.col("_a"), F.col("t"), 36 * HOUR / 1e6, ["left_wrench", "right_wrench"]
    )
    return (
        both.select("event_id", "t", before.alias("_b"), after.alias("_a"))
        .select("event_id", f.alias("f"))
        .select(
            "event_id",
            F.col("f.valid").alias("force_valid"),
            F.col("f.dropped_reason").alias("force_reason"),
            r6("f.alpha").alias("alpha"),
            r6(F.get("f.left_wrench", F.lit(0))).alias("left0"),
            r6(F.get("f.right_wrench", F.lit(1))).alias("right1"),
        )
    )


@query(
    "j5_clamped_interpolation",
    f"""WITH {NEAR_SQL} SELECT v.event_id,
  {q6('''CASE WHEN pb.at IS NULL THEN pa.val WHEN pa.at IS NULL OR pa.at = pb.at THEN pb.val
  ELSE pb.val + (pa.val - pb.val) * ((v.t - pb.at)::DOUBLE / (pa.at - pb.at)) END''')} AS width
  FROM v LEFT JOIN pb USING (event_id) LEFT JOIN pa USING (event_id)""",
)
def j5_clamped_interpolation(t: Tables):
    views, _, purchases = streams(t)
    out = asof.clamped_interpolation(views, purchases, KEYS, "t", "event_id", ["value"])
    return out.select("event_id", r6("x_value").alias("width"))


@query(
    "p17_stream_payload",
    f"""{TIMELINE_CTE} SELECT camera_reason, force_reason, count(*) AS n FROM tl GROUP BY 1, 2""",
)
def p17_stream_payload(t: Tables):
    return (
        timeline(t)
        .groupBy(
            F.col("camera.dropped_reason").alias("camera_reason"),
            F.col("force.dropped_reason").alias("force_reason"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "a1_alignment_counters",
    f"""{TIMELINE_CTE} SELECT user_id, count(*) AS timeline_rows, count(*) AS frame_valid,
  count(*) FILTER (camera_valid) AS camera_valid, count(*) FILTER (force_valid) AS force_valid,
  count(*) FILTER (all_valid) AS all_valid FROM tl GROUP BY 1""",
)
def a1_alignment_counters(t: Tables):
    return alignment.alignment_counts(timeline(t), KEYS)


@query(
    "a2_source_reuse",
    f"""{TIMELINE_CTE} SELECT user_id,
  count(DISTINCT CASE WHEN camera_valid THEN camera_id END) AS unique_sources,
  count(CASE WHEN camera_valid THEN camera_id END)
    - count(DISTINCT CASE WHEN camera_valid THEN camera_id END) AS duplicate_targets
  FROM tl GROUP BY 1""",
)
def a2_source_reuse(t: Tables):
    return alignment.source_reuse(timeline(t), KEYS, "camera", "camera.row.event_id")


@query(
    "w6_sample_index",
    f"""SELECT event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS sample_index,
  row_number() OVER (ORDER BY user_id, t, event_id) - 1 AS global_sample_index
  FROM {EV} WHERE event_type = 'view'""",
)
def w6_sample_index(t: Tables):
    views, _, _ = streams(t)
    indexed = alignment.sample_index(views, KEYS, ["t", "event_id"])
    return alignment.global_index(indexed, ["user_id", "t", "event_id"]).select(
        "event_id", "sample_index", "global_sample_index"
    )


WINDOWS_SQL = f"""
s AS (SELECT user_id, event_id AS window_id, t AS start_ns, t + {12 * HOUR} AS end_ns
      FROM {EV} WHERE event_type = 'signup')"""


def windows(t: Tables):
    return t.events("signup").select(
        "user_id",
        F.col("event_id").alias("window_id"),
        F.col("t").alias("start_ns"),
        (F.col("t") + 12 * HOUR).alias("end_ns"),
    )


@query(
    "j9_samples_in_windows",
    f"""WITH {WINDOWS_SQL} SELECT e.event_id, s.window_id FROM {EV} e JOIN s
  ON e.user_id = s.user_id AND e.t BETWEEN s.start_ns AND s.end_ns WHERE e.event_type <> 'signup'""",
)
def j9_samples_in_windows(t: Tables):
    samples = t.events("click", "view", "purchase", "error")
    return asof.windows_join(
        samples, windows(t), KEYS, "t", "start_ns", "end_ns", DAY
    ).select("event_id", "window_id")


@query(
    "e5_uniform_timeline",
    f"""WITH {WINDOWS_SQL}, g AS (SELECT window_id, start_ns,
  unnest(range(((end_ns - start_ns) // 1800000000000)::BIGINT)) AS tick FROM s)
  SELECT window_id, tick, start_ns + tick * 1800000000000 AS t FROM g""",
)
def e5_uniform_timeline(t: Tables):
    """One tick every half hour."""
    return alignment.uniform_targets(
        windows(t), ["window_id"], "start_ns", "end_ns", 1 / 1800
    ).select("window_id", "tick", "t")


TICK_NS = 2 * HOUR

# ticks of every user's span, the nearest view and click and the bracketing purchases of each
TICK_SQL = f"""
ep AS (SELECT user_id, min(t) AS s, max(t) AS e FROM {EV} GROUP BY 1),
k AS (SELECT user_id, tick, s + tick * {TICK_NS} AS t
      FROM (SELECT user_id, s, unnest(range((e - s) // {TICK_NS})) AS tick FROM ep)),
x AS (SELECT event_type, user_id, event_id, t, value FROM {EV}),
near AS (SELECT k.user_id, k.tick, k.t,
  vb.event_id AS vbi, vb.t AS vbt, va.event_id AS vai, va.t AS vat,
  cb.event_id AS cbi, cb.t AS cbt, ca.event_id AS cai, ca.t AS cat,
  pb.event_id AS pbi, pb.t AS pbt, pb.value AS pbv, pa.event_id AS pai, pa.t AS pat, pa.value AS pav
  FROM k
  ASOF LEFT JOIN (SELECT * FROM x WHERE event_type = 'view') vb ON k.user_id = vb.user_id AND k.t >= vb.t
  ASOF LEFT JOIN (SELECT * FROM x WHERE event_type = 'view') va ON k.user_id = va.user_id AND k.t <= va.t
  ASOF LEFT JOIN (SELECT * FROM x WHERE event_type = 'click') cb ON k.user_id = cb.user_id AND k.t >= cb.t
  ASOF LEFT JOIN (SELECT * FROM x WHERE event_type = 'click') ca ON k.user_id = ca.user_id AND k.t <= ca.t
  ASOF LEFT JOIN (SELECT * FROM x WHERE event_type = 'purchase') pb ON k.user_id = pb.user_id AND k.t >= pb.t
  ASOF LEFT JOIN (SELECT * FROM x WHERE event_type = 'purchase') pa ON k.user_id = pa.user_id AND k.t <= pa.t),
picked AS (SELECT *,
  CASE WHEN vbt IS NULL THEN vai WHEN vat IS NULL OR t - vbt < vat - t THEN vbi ELSE vai END AS frame_id,
  CASE WHEN vbt IS NULL THEN vat WHEN vat IS NULL OR t - vbt < vat - t THEN vbt ELSE vat END - t AS vd,
  CASE WHEN cbt IS NULL THEN cai WHEN cat IS NULL OR t - cbt < cat - t THEN cbi ELSE cai END AS camera_id,
  CASE WHEN cbt IS NULL THEN cat WHEN cat IS NULL OR t - cbt < cat - t THEN cbt ELSE cat END - t AS cd
  FROM near),
judged AS (SELECT *, coalesce(abs(vd) <= {6 * HOUR}, false) AS frame_valid,
  coalesce(abs(cd) <= {6 * HOUR}, false) AS camera_valid,
  coalesce(pat - pbt <= {36 * HOUR}, false) AS force_valid,
  CASE WHEN t - pbt <= pat - t THEN pbi ELSE pai END AS near_force,
  CASE WHEN pbt IS NULL OR pat IS NULL THEN NULL WHEN t - pbt <= pat - t THEN pbt ELSE pat END - t AS fd,
  CASE WHEN pat = pbt THEN 0.0::DOUBLE ELSE (t - pbt)::DOUBLE / (pat - pbt) END AS al FROM picked),
ticks AS (SELECT *, frame_valid AND camera_valid AND force_valid AS all_valid FROM judged)"""


def tick_timeline(t: Tables, rows_per_task: int | None = None):
    """Ticks over every user's span; views are the phone."""
    views, clicks, purchases = streams(t)
    spans = t.events().groupBy("user_id").agg(F.min("t").alias("s"), F.max("t").alias("e"))
    named = views.withColumn("path", F.concat(F.lit("v/"), F.col("event_id").cast("string")))
    return alignment.align(
        alignment.uniform_targets(spans, KEYS, "s", "e", 1e9 / TICK_NS),
        clicks,
        purchases,
        KEYS,
        "t",
        "tick",
        camera_max_ms=6 * HOUR / 1e6,
        force_max_ms=36 * HOUR / 1e6,
        rows_per_task=rows_per_task,
        phone=asof.Stream(named, "t", "event_id"),
        phone_max_ms=6 * HOUR / 1e6,
    )


TICKS_OUT = f"""SELECT user_id, tick, t, frame_valid, {q6("vd / 1e6")} AS frame_delta_ms,
  CASE WHEN vd IS NULL THEN 'missing_stream' WHEN NOT frame_valid
       THEN 'nearest_sample_outside_threshold' END AS frame_reason, frame_id,
  camera_valid, {q6("cd / 1e6")} AS camera_delta_ms, camera_id, force_valid,
  CASE WHEN force_valid THEN {q6("al")} END AS alpha,
  CASE WHEN force_valid THEN {q6("pbv + (pav - pbv) * al")} END AS left0, all_valid FROM ticks"""


def _ticks_out(df):
    return df.select(
        "user_id",
        "tick",
        "t",
        F.col("frame.valid").alias("frame_valid"),
        r6("frame.source_delta_ms").alias("frame_delta_ms"),
        F.col("frame.dropped_reason").alias("frame_reason"),
        F.col("frame.row.event_id").alias("frame_id"),
        F.col("camera.valid").alias("camera_valid"),
        r6("camera.source_delta_ms").alias("camera_delta_ms"),
        F.col("camera.row.event_id").alias("camera_id"),
        F.col("force.valid").alias("force_valid"),
        r6("force.alpha").alias("alpha"),
        r6(F.get("force.left_wrench", F.lit(0))).alias("left0"),
        "all_valid",
    )


@query("align_target_fps", f"WITH {TICK_SQL} {TICKS_OUT}")
def align_target_fps(t: Tables):
    return _ticks_out(tick_timeline(t))


@query("align_target_fps_cut_keys", f"WITH {TICK_SQL} {TICKS_OUT}")
def align_target_fps_cut_keys(t: Tables):
    return _ticks_out(tick_timeline(t, rows_per_task=200))


@query(
    "a2_frame_reuse_on_ticks",
    f"""WITH {TICK_SQL} SELECT user_id, count(DISTINCT frame_id) FILTER (frame_valid) AS unique_sources,
  count(*) FILTER (frame_valid) - count(DISTINCT frame_id) FILTER (frame_valid) AS duplicate_targets
  FROM ticks GROUP BY user_id""",
)
def a2_frame_reuse_on_ticks(t: Tables):
    return alignment.source_reuse(tick_timeline(t), KEYS, "frame", "frame.row.event_id")


@query(
    "e6_frame_timeline",
    f"""WITH ep AS (SELECT user_id, min(t) AS s, max(t) AS e FROM {EV} GROUP BY 1),
  p AS (SELECT user_id, event_id, t FROM {EV} WHERE event_type = 'view' AND value > 60),
  q AS (SELECT user_id, event_id, t FROM {EV} WHERE event_type = 'click')
  SELECT * FROM p UNION ALL SELECT q.* FROM q JOIN ep USING (user_id)
  WHERE q.t BETWEEN ep.s AND ep.e AND user_id NOT IN (SELECT user_id FROM p)""",
)
def e6_frame_timeline(t: Tables):
    episodes = t.events().groupBy("user_id").agg(F.min("t").alias("s"), F.max("t").alias("e"))
    cols = ["user_id", "event_id", "t"]
    primary = t.events("view").where(F.col("value") > 60).select(*cols)
    return alignment.frame_targets(
        episodes, primary, t.events("click").select(*cols), KEYS, "t", "s", "e"
    )


@query(
    "w13_latest_gripper_sample",
    f"""WITH v AS (SELECT * FROM {EV} WHERE event_type = 'view'),
  c AS (SELECT * FROM {EV} WHERE event_type = 'click')
  SELECT v.event_id, c.event_id AS sample_id, v.t - c.t AS age_ns
  FROM v ASOF LEFT JOIN c ON v.user_id = c.user_id AND v.t >= c.t""",
)
def w13_latest_gripper_sample(t: Tables):
    views, clicks, _ = streams(t)
    out = asof.backward_join(views, clicks, KEYS, "t", "event_id", "g")
    return out.select(
        "event_id", F.col("g.event_id").alias("sample_id"), F.col("g_age").alias("age_ns")
    )
