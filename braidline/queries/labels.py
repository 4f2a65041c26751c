"""Queries: labels, smoothing and tracking along an episode; sorts, pages and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from braidline.operators import labels, ordering, relations
from braidline.ordered import floor_div
from braidline.queries.base import EV, HOUR, ORD, Tables, q6, query, r6, stamp, stamp_sql

KEYS = ["user_id"]
ORDER = ["t", "event_id"]
W = "WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)"
POSE = "value, value * 2, event_id::DOUBLE, 0.0, -value, 1.0"


def posed(t: Tables):
    v, e = F.col("value"), F.col("event_id").cast("double")
    return t.events().withColumn("pos", F.array(v, v * 2, e, F.lit(0.0), -v, F.lit(1.0)))


W1_SQL = f"""SELECT event_id, {q6("coalesce(lead(value) OVER w - value, 0)")} AS a0,
  {q6("coalesce(lead(value * 2) OVER w - value * 2, 0)")} AS a1,
  {q6("coalesce(lead(event_id) OVER w - event_id, 0)")} AS a2 FROM {EV} {W}"""


def _w1(t: Tables, rows_per_task=None):
    out = labels.pose_actions(posed(t), KEYS, ORDER, "pos", rows_per_task=rows_per_task)
    return out.select(
        "event_id", *[r6(F.get("action", F.lit(i))).alias(f"a{i}") for i in range(3)]
    )


@query("w1_pose_actions", W1_SQL)
def w1_pose_actions(t: Tables):
    return _w1(t)


@query("w1_pose_actions_cut_keys", W1_SQL)
def w1_pose_actions_cut_keys(t: Tables):
    """The same with every large episode cut into pieces."""
    return _w1(t, 30)


@query(
    "w2_gripper_actions",
    f"""SELECT event_id, coalesce(lead(CASE WHEN value > 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) OVER w,
  CASE WHEN value > 20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS gripper_action FROM {EV} {W}""",
)
def w2_gripper_actions(t: Tables):
    rows = t.events().withColumn("state", F.when(F.col("value") > 20, 1.0).otherwise(0.0))
    return labels.gripper_actions(rows, KEYS, ORDER, "state").select("event_id", "gripper_action")


@query(
    "w3_export_actions",
    f"""SELECT event_id, {q6("coalesce(lead(value) OVER w - value, value - lag(value) OVER w, 0)")} AS action
  FROM {EV} WINDOW w AS (ORDER BY user_id, t, event_id)""",
)
def w3_export_actions(t: Tables):
    out = labels.export_actions(t.events(), ["user_id", *ORDER], ["value"])
    return out.select("event_id", r6("action_value").alias("action"))


W4_SQL = f"""SELECT event_id, {q6("avg(value) OVER (PARTITION BY user_id, event_type ORDER BY t, event_id ROWS 4 PRECEDING)")} AS smooth FROM {EV}"""


@query("w4_moving_average", W4_SQL)
def w4_moving_average(t: Tables):
    out = labels.moving_average(t.events(), ["user_id", "event_type"], ORDER, ["value"])
    return out.select("event_id", r6("value_avg").alias("smooth"))


@query("w4_moving_average_cut_keys", W4_SQL)
def w4_moving_average_cut_keys(t: Tables):
    out = labels.moving_average(
        t.events(), ["user_id", "event_type"], ORDER, ["value"], rows_per_task=15
    )
    return out.select("event_id", r6("value_avg").alias("smooth"))


@query(
    "w5_tare_progress",
    f"""WITH r AS (SELECT *, row_number() OVER w AS k FROM {EV} {W}),
  o AS (SELECT user_id, avg(value) AS o FROM r WHERE k > 5 AND k <= 20 GROUP BY 1)
  SELECT event_id, CASE WHEN k >= 20 THEN 'ok' ELSE 'tare_pending' END AS calibration_status,
    least(k, 20) AS tare_count, CASE WHEN k >= 20 THEN {q6("value - o")} END AS zeroed
  FROM r LEFT JOIN o USING (user_id)""",
)
def w5_tare_progress(t: Tables):
    out = labels.tare_progress(t.events(), KEYS, ORDER, ["value"], target=20, ignored=5)
    return out.select(
        "event_id", "calibration_status", "tare_count", r6("value_zeroed").alias("zeroed")
    )


@query(
    "w7_segment_frame_index",
    """SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) - 1
  AS segment_frame_index FROM conversations""",
)
def w7_segment_frame_index(t: Tables):
    out = labels.segment_frame_index(t.conversations(), ["conv_id", "role"], ["turn"])
    return out.select("conv_id", "turn", "segment_frame_index")


W8_SQL = f"""WITH RECURSIVE r AS (SELECT event_id, user_id, value,
    row_number() OVER w AS k FROM {EV} {W}),
  s AS (SELECT user_id, k, event_id, value AS y FROM r WHERE k = 1
    UNION ALL SELECT r.user_id, r.k, r.event_id, s.y * 0.65 + r.value * 0.35
    FROM s JOIN r ON r.user_id = s.user_id AND r.k = s.k + 1)
  SELECT event_id, {stamp_sql("event_id")} AS stamp, {q6("y")} AS smoothed FROM s"""


@query("w8_exponential_smoothing", W8_SQL)
def w8_exponential_smoothing(t: Tables):
    rows = t.events().withColumn("stamp", stamp("event_id"))
    out = labels.exponential_smoothing(rows, KEYS, ORDER, "value", 0.35)
    return out.select("event_id", "stamp", r6("smoothed").alias("smoothed"))


@query("w8_exponential_smoothing_cut_keys", W8_SQL)
def w8_exponential_smoothing_cut_keys(t: Tables):
    rows = t.events().withColumn("stamp", stamp("event_id"))
    out = labels.exponential_smoothing(rows, KEYS, ORDER, "value", 0.35, rows_per_task=30)
    return out.select("event_id", "stamp", r6("smoothed").alias("smoothed"))


@query(
    "w9_held_marker",
    f"""WITH f AS (SELECT event_id, t, CASE WHEN event_type = 'view' THEN value END AS v,
    last_value(CASE WHEN event_type = 'view' THEN t END IGNORE NULLS) OVER w AS lt,
    last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER w AS lv FROM {EV} {W})
  SELECT event_id, CASE WHEN t - lt <= {20 * HOUR} THEN lv END AS held_value,
    t - lt AS held_age, v IS NULL AND coalesce(t - lt <= {20 * HOUR}, false) AS is_held FROM f""",
)
def w9_held_marker(t: Tables):
    rows = t.events().withColumn("v", F.when(F.col("event_type") == "view", F.col("value")))
    out = labels.held_marker(rows, KEYS, ORDER, "t", "v", 20 * HOUR)
    return out.select("event_id", "held_value", "held_age", "is_held")


@query(
    "w9_decayed_confidence",
    f"""WITH RECURSIVE r AS (SELECT event_id, user_id, row_number() OVER w AS k,
    CASE WHEN event_type = 'view' THEN least(1.0, value / 50) END AS c FROM {EV} {W}),
  s AS (SELECT user_id, k, event_id, coalesce(c, 0.0)::DOUBLE AS y FROM r WHERE k = 1
    UNION ALL SELECT r.user_id, r.k, r.event_id,
      coalesce(r.c, greatest(0.0, s.y * 0.94 - 0.015)) FROM s JOIN r
      ON r.user_id = s.user_id AND r.k = s.k + 1)
  SELECT event_id, {q6("y")} AS confidence FROM s""",
)
def w9_decayed_confidence(t: Tables):
    c = F.when(F.col("event_type") == "view", F.least(F.lit(1.0), F.col("value") / 50))
    out = labels.decayed_confidence(t.events().withColumn("c", c), KEYS, ORDER, "c")
    return out.select("event_id", r6("decayed_confidence").alias("confidence"))


@query(
    "w10_fused_opening",
    f"""WITH m AS (SELECT user_id, t // {6 * HOUR} AS frame, event_id, event_type = 'view' AS m1,
      300.0 + (value * 7) % 300 AS x, 200.0 + (value * 13) % 40 AS y, value * 30 AS area, event_id % 3 AS kd
    FROM {EV} WHERE event_type IN ('view', 'click')),
  f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, frame, m1 ORDER BY event_id DESC) AS k FROM m) WHERE k = 1),
  p AS (SELECT *, CASE WHEN m1 THEN 300.0 ELSE 200.0 END AS len FROM f),
  q AS (SELECT *, greatest(0.0, least(1.0, (x - 300.0) / len)) AS u FROM p),
  g AS (SELECT *, u * 100 AS pc, greatest(0.001, greatest(0.0, 1 - sqrt((x - (300.0 + u * len)) ** 2
      + (y - 210.0) ** 2) / 40.0) * least(1.0, greatest(0.25, area / 900.0))
      * CASE kd WHEN 0 THEN 1.0 WHEN 1 THEN 0.45 ELSE 0.2 END) AS w FROM q),
  a AS (SELECT user_id, frame, count(*) AS n, sum(w) AS sw, sum(w * pc) AS wp, max(pc) - min(pc) AS ap FROM g GROUP BY 1, 2)
  SELECT user_id, frame, n AS markers, {q6("greatest(0, least(100, wp / sw))")} AS open_percent,
    {q6("greatest(0, least(1, least(1, sw / n) * CASE WHEN n >= 2 THEN greatest(0, 1 - ap / 30) ELSE 0.62 END))")} AS confidence
  FROM a""",
)
def w10_fused_opening(t: Tables):
    kinds = F.create_map(
        *[F.lit(x) for kv in {0: "detected", 1: "path_candidate", 2: "held"}.items() for x in kv]
    )
    seen = t.events("view", "click").select(
        "user_id",
        floor_div(F.col("t"), 6 * HOUR).alias("frame"),
        (F.col("event_type") == "view").cast("int").alias("marker"),
        "event_id",
        (F.lit(300.0) + (F.col("value") * 7) % 300).alias("x"),
        (F.lit(200.0) + (F.col("value") * 13) % 40).alias("y"),
        (F.col("value") * 30).alias("area"),
        kinds[(F.col("event_id") % 3).cast("int")].alias("kind"),
        F.lit(40.0).alias("error_limit"),
    )
    latest = relations.latest_by(seen, ["user_id", "frame", "marker"], ["event_id"])
    paths = (
        seen.groupBy("marker")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "marker",
            F.lit(300.0).alias("ax"),
            F.lit(210.0).alias("ay"),
            (F.lit(500.0) + F.col("marker") * 100).alias("bx"),
            F.lit(210.0).alias("by"),
        )
    )
    out = labels.fused_opening(latest, paths, ["user_id", "frame"])
    return out.select(
        "user_id",
        "frame",
        "markers",
        r6("open_percent").alias("open_percent"),
        r6("confidence").alias("confidence"),
    )


@query(
    "w11_step_durations",
    f"SELECT event_id, {q6('(lead(t) OVER w - t) / 1e6')} AS dt_ms FROM {EV} {W}",
)
def w11_step_durations(t: Tables):
    out = labels.step_durations(t.events(), KEYS, ORDER, "t")
    return out.select("event_id", r6("dt_ms").alias("dt_ms"))


@query(
    "w12_strictly_increasing",
    f"""WITH s AS (SELECT o_custkey, t, lag(t) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM {ORD})
  SELECT o_custkey, count(*) FILTER (t <= p) = 0 AS strictly_increasing,
    count(*) FILTER (t <= p) AS violations FROM s GROUP BY 1""",
)
def w12_strictly_increasing(t: Tables):
    return labels.strictly_increasing(t.orders(), ["o_custkey"], ["o_orderkey"], "t")


@query(
    "o1_sort_by_time",
    f"""SELECT event_id, row_number() OVER (ORDER BY t, event_id) - 1 AS position FROM {EV}
  WHERE event_id % 9 <> 0""",
)
def o1_sort_by_time(t: Tables):
    rows = t.events().withColumn("at", F.when(F.col("event_id") % 9 != 0, F.col("t")))
    return ordering.by_time(rows, "at", "event_id").select("event_id", "position")


@query(
    "o2_event_order",
    f"SELECT event_id, row_number() OVER (ORDER BY t // {24 * HOUR}, event_id) - 1 AS position FROM {EV}",
)
def o2_event_order(t: Tables):
    rows = t.events().withColumn("day", floor_div(F.col("t"), 24 * HOUR))
    return ordering.by_time(rows, "day", "event_id").select("event_id", "position")


@query(
    "o3_latest_item",
    f"""SELECT user_id, max_by(event_id, t) AS event_id, max(t) AS at FROM
  (SELECT user_id, event_id, CASE WHEN event_type = 'view' THEN t - 5 ELSE t END AS t FROM {EV}) GROUP BY 1""",
)
def o3_latest_item(t: Tables):
    rows = t.events().select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") != "view", F.col("t")).alias("recorded"),
        (F.col("t") - 5).alias("modified"),
    )
    return ordering.latest_item(rows, ["user_id"], "recorded", "modified", "event_id")


@query(
    "o4_series_page",
    f"""SELECT event_id, user_id, i AS sample_index FROM (SELECT *, row_number() OVER w - 1 AS i FROM {EV} {W})
  WHERE i >= 10 AND i < 15""",
)
def o4_series_page(t: Tables):
    page = ordering.series_page(t.events(), KEYS, ORDER, 10, 5)
    return page.select("event_id", "user_id", "sample_index")


@query(
    "o5_newest_first",
    f"""SELECT user_id, u, row_number() OVER (ORDER BY u DESC, user_id) - 1 AS position
  FROM (SELECT user_id, max(t) AS u FROM {EV} GROUP BY 1)""",
)
def o5_newest_first(t: Tables):
    runs = t.events().groupBy("user_id").agg(F.max("t").alias("u"))
    return ordering.newest_first(runs, "u", "user_id")


@query(
    "u1_concatenated_sources",
    f"""SELECT event_id, user_id, source FROM (SELECT event_id, user_id, 'a' AS source FROM {EV}
  WHERE event_type = 'view' UNION ALL SELECT event_id, user_id, 'b' FROM {EV} WHERE value > 30)""",
)
def u1_concatenated_sources(t: Tables):
    a = t.events("view").select("event_id", "user_id", F.lit("a").alias("source"))
    b = t.events().where(F.col("value") > 30).select("user_id", "event_id", F.lit("b").alias("source"))
    return ordering.concatenated([a, b])


@query(
    "u2_distinct_union",
    f"""SELECT user_id FROM {EV} WHERE event_type = 'view' AND value > 50 UNION
  SELECT user_id FROM {EV} WHERE value > 100""",
)
def u2_distinct_union(t: Tables):
    a = t.events("view").where(F.col("value") > 50).select("user_id")
    b = t.events().where(F.col("value") > 100).select("user_id")
    return ordering.distinct_union([a, b])
