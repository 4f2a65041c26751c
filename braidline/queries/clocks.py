"""Queries: clocks, counters and episode segmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from braidline.operators import clocks, episodes
from braidline.ordered import floor_div
from braidline.queries.base import DAY, EV, HOUR, Tables, q6, query, r6

U32 = 4294967296

# the event time in microseconds, cut to 32 bits, is a device counter per event type
COUNTER = f"(SELECT event_id, event_type, (t // 1000) % {U32} AS raw FROM {EV})"
STEPS = f"""st AS (SELECT *, lag(raw) OVER w - raw AS d FROM {COUNTER}
  WINDOW w AS (PARTITION BY event_type ORDER BY event_id))"""


def counter(t: Tables):
    return t.events().select(
        "event_id", "event_type", F.pmod(floor_div(F.col("t"), 1000), F.lit(U32)).alias("raw")
    )


@query(
    "c1_unwrap_counter",
    f"""WITH {STEPS} SELECT event_id,
  (raw + {U32} * sum(CASE WHEN d > {U32 // 2} THEN 1 ELSE 0 END)
    OVER (PARTITION BY event_type ORDER BY event_id))::BIGINT AS unwrapped,
  coalesce(d > 0 AND d <= {U32 // 2}, false) AS clock_reset FROM st""",
)
def c1_unwrap_counter(t: Tables):
    return clocks.unwrap_counter(counter(t), ["event_type"], ["event_id"], "raw").select(
        "event_id", "unwrapped", "clock_reset"
    )


@query(
    "c1_unwrap_counter_cut_keys",
    f"""WITH {STEPS} SELECT event_id,
  (raw + {U32} * sum(CASE WHEN d > {U32 // 2} THEN 1 ELSE 0 END)
    OVER (PARTITION BY event_type ORDER BY event_id))::BIGINT AS unwrapped,
  coalesce(d > 0 AND d <= {U32 // 2}, false) AS clock_reset FROM st""",
)
def c1_unwrap_counter_cut_keys(t: Tables):
    """The same with every source cut into pieces."""
    return clocks.unwrap_counter(
        counter(t), ["event_type"], ["event_id"], "raw", rows_per_task=300
    ).select("event_id", "unwrapped", "clock_reset")


# device time x, host time y with jitter; sources 6 and 7 have no usable model
PAIRS = f"""(SELECT event_id, user_id % 8 AS source, event_id * 5000000 AS x,
  2000000000000 + event_id * 5000375 + (value * 1000)::BIGINT AS y,
  (user_id % 8 = 7 AND event_id % 100 = 0) AS reset FROM {EV}
  WHERE user_id % 8 <> 6)"""
FIT_SQL = f"""line AS (SELECT source, count(*) AS n, max(x) - min(x) AS span,
  regr_slope(y::DOUBLE, x::DOUBLE) AS scale, avg(x::DOUBLE) AS mx, avg(y::DOUBLE) AS my FROM {PAIRS}
  GROUP BY 1 HAVING NOT bool_or(reset) AND count(*) >= 8 AND max(x) - min(x) >= 20000000
    AND regr_slope(y::DOUBLE, x::DOUBLE) BETWEEN 0.999 AND 1.001),
res AS (SELECT p.source, (p.y - my) - scale * (p.x - mx) AS r FROM {PAIRS} p JOIN line USING (source)),
pc AS (SELECT source, quantile_cont(r, 0.01) AS p1, quantile_cont(r, 0.5) AS p50,
  quantile_cont(r, 0.95) AS p95, quantile_cont(r, 0.99) AS p99, max(r) AS pm FROM res GROUP BY 1)"""


def pairs(t: Tables):
    source = F.pmod(F.col("user_id"), F.lit(8))
    return (
        t.events()
        .where(source != 6)
        .select(
            "event_id",
            source.alias("source"),
            (F.col("event_id") * 5_000_000).alias("x"),
            (
                F.lit(2_000_000_000_000)
                + F.col("event_id") * 5_000_375
                + F.rint(F.col("value") * 1000).cast("long")
            ).alias("y"),
            ((source == 7) & (F.col("event_id") % 100 == 0)).alias("reset"),
        )
    )


def r3(x):
    return F.round(x, 3) + F.lit(0.0)


@query(
    "c2_lower_envelope_fit",
    f"""WITH {FIT_SQL} SELECT source, n AS sample_count, round(scale, 9) AS scale,
  round(my - scale * mx + p1, -2) AS offset_ns, round((p50 - p1) / 1e6, 5) AS residual_p50_ms,
  round((p95 - p1) / 1e6, 5) AS residual_p95_ms, round((p99 - p1) / 1e6, 5) AS residual_p99_ms,
  round((pm - p1) / 1e6, 5) AS residual_max_ms FROM line JOIN pc USING (source)""",
)
def c2_lower_envelope_fit(t: Tables):
    fit = clocks.lower_envelope_fit(pairs(t), ["source"], "x", "y", "reset")
    return fit.select(
        "source",
        "sample_count",
        F.round("scale", 9).alias("scale"),
        F.round("offset_ns", -2).alias("offset_ns"),
        *[
            F.round(f"residual_{p}_ms", 5).alias(f"residual_{p}_ms")
            for p in ("p50", "p95", "p99", "max")
        ],
    )


@query(
    "c5_apply_clock_model",
    f"""WITH {FIT_SQL}, m AS (SELECT source, scale, my - scale * mx + p1 AS off
    FROM line JOIN pc USING (source))
  SELECT p.source, CASE WHEN m.source IS NOT NULL AND NOT p.reset
    THEN 'device_affine_lower_envelope' ELSE 'host_receive_fallback' END AS method,
    count(*) AS n,
    round(avg((p.y - CASE WHEN m.source IS NOT NULL AND NOT p.reset
      THEN round(scale * p.x + off)::BIGINT ELSE p.y END) / 1e6), 4) AS mean_delay_ms
  FROM {PAIRS} p LEFT JOIN m USING (source) GROUP BY 1, 2""",
)
def c5_apply_clock_model(t: Tables):
    rows = pairs(t)
    fit = clocks.lower_envelope_fit(rows, ["source"], "x", "y", "reset")
    mapped = clocks.apply_envelope(rows, fit, ["source"], "x", "y", "reset")
    return mapped.groupBy("source", F.col("alignment_method").alias("method")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("arrival_delay_ms"), 4).alias("mean_delay_ms"),
    )


# clock exchanges: round trips from 0.2 ms up, per source
EXCHANGE = f"""(SELECT event_id, user_id % 5 AS session, event_id * 20000000 AS phone,
  2000000000000 + (event_id * 19999000) + (event_id * 37) % 1000 AS host,
  200000 + (value * 5000)::BIGINT AS rtt FROM {EV})"""


def exchanges(t: Tables):
    e = F.col("event_id")
    return t.events().select(
        "event_id",
        F.pmod(F.col("user_id"), F.lit(5)).alias("session"),
        (e * 20_000_000).alias("phone"),
        (F.lit(2_000_000_000_000) + e * 19_999_000 + (e * 37) % 1000).alias("host"),
        (F.lit(200_000) + F.rint(F.col("value") * 5000).cast("long")).alias("rtt"),
    )


@query(
    "c3_two_way_fit",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY rtt, event_id) AS k,
    count(*) OVER (PARTITION BY session) AS n FROM {EXCHANGE}),
  s AS (SELECT * FROM r WHERE k <= least(n, greatest(8, ceil(n * 0.2)))),
  l AS (SELECT session, max(n) AS n, count(*) AS m, max(phone) - min(phone) AS span,
    regr_slope(host::DOUBLE, phone::DOUBLE) AS slope, avg(phone::DOUBLE) AS mx,
    avg(host::DOUBLE) AS my FROM s GROUP BY 1),
  l2 AS (SELECT *, m >= 4 AND span >= 2000000000 AND slope BETWEEN 0.999 AND 1.001 AS fit FROM l),
  l3 AS (SELECT *, CASE WHEN fit THEN slope ELSE 1.0 END AS scale FROM l2),
  o AS (SELECT s.session, (host - my) - scale * (phone - mx) AS o FROM s JOIN l3 USING (session)),
  md AS (SELECT session, median(o) AS mid FROM o GROUP BY 1),
  rs AS (SELECT session, quantile_cont(abs(o - mid), 0.5) AS r50,
    quantile_cont(abs(o - mid), 0.95) AS r95 FROM o JOIN md USING (session) GROUP BY 1),
  tr AS (SELECT session, quantile_cont(rtt::DOUBLE, 0.5) AS t50, quantile_cont(rtt::DOUBLE, 0.95) AS t95
    FROM {EXCHANGE} GROUP BY 1)
  SELECT session, CASE WHEN fit THEN 'bidirectional_affine_low_rtt' ELSE 'bidirectional_offset' END
    AS method, n AS sample_count, m AS selected_sample_count, round(scale, 9) AS scale,
    round(my - scale * mx + mid, -2) AS offset_ns, round(t50 / 1e6, 6) AS rtt_p50_ms,
    round(t95 / 1e6, 6) AS rtt_p95_ms, round(r50 / 1e6, 5) AS residual_p50_ms,
    round(r95 / 1e6, 5) AS residual_p95_ms
  FROM l3 JOIN md USING (session) JOIN rs USING (session) JOIN tr USING (session)""",
)
def c3_two_way_fit(t: Tables):
    fit = clocks.two_way_fit(exchanges(t), ["session"], "phone", "host", "rtt", "event_id")
    return fit.select(
        "session",
        "method",
        "sample_count",
        "selected_sample_count",
        F.round("scale", 9).alias("scale"),
        F.round("offset_ns", -2).alias("offset_ns"),
        F.round("rtt_p50_ms", 6).alias("rtt_p50_ms"),
        F.round("rtt_p95_ms", 6).alias("rtt_p95_ms"),
        F.round("residual_p50_ms", 5).alias("residual_p50_ms"),
        F.round("residual_p95_ms", 5).alias("residual_p95_ms"),
    )


@query(
    "c4_one_way_offset",
    f"SELECT session, min(host - phone) AS one_way_offset_ns FROM {EXCHANGE} GROUP BY 1",
)
def c4_one_way_offset(t: Tables):
    return clocks.one_way_offset(exchanges(t), ["session"], "phone", "host")


@query(
    "c6_unix_offset",
    f"""WITH d AS (SELECT session, host - phone AS d,
    row_number() OVER (PARTITION BY session ORDER BY host - phone) AS k,
    count(*) OVER (PARTITION BY session) AS n FROM {EXCHANGE})
  SELECT session, d AS unix_minus_mono_ns FROM d WHERE k = n // 2 + 1""",
)
def c6_unix_offset(t: Tables):
    return clocks.unix_offset(exchanges(t), ["session"], "host", "phone")


@query(
    "c7_anchored_offset",
    f"""WITH e AS (SELECT DISTINCT user_id, user_id % 5 AS run FROM {EV}),
  a AS (SELECT user_id, min(t) + 1700 - min(event_id) AS own FROM {EV}
    WHERE event_type = 'signup' AND value > 50 GROUP BY 1),
  f AS (SELECT user_id % 5 AS run, min(t) AS d FROM {EV} WHERE user_id % 5 <> 3 GROUP BY 1)
  SELECT user_id, coalesce(own, d) AS offset_ns, CASE WHEN own IS NOT NULL
    THEN 'episode_event_anchor' WHEN d IS NOT NULL THEN 'run_fallback' END AS offset_source
  FROM e LEFT JOIN a USING (user_id) LEFT JOIN f USING (run)""",
)
def c7_anchored_offset(t: Tables):
    run = F.pmod(F.col("user_id"), F.lit(5)).alias("run")
    rows = t.events()
    anchors = (
        t.events("signup")
        .where(F.col("value") > 50)
        .groupBy("user_id")
        .agg(
            (F.min("t") + 1700).alias("anchor_unix_ns"), F.min("event_id").alias("anchor_mono_ns")
        )
    )
    fallback = (
        rows.select("t", run)
        .where(F.col("run") != 3)
        .groupBy("run")
        .agg(F.min("t").alias("unix_minus_mono_ns"))
    )
    out = clocks.anchored_offset(
        rows.select("user_id", run).distinct(), anchors, ["user_id"], fallback, ["run"]
    )
    return out.select("user_id", "offset_ns", "offset_source")


@query(
    "c8_latency_correction",
    f"""WITH m AS (SELECT event_type, trunc(quantile_cont(value * 1e6, 0.5))::BIGINT AS mid
    FROM {EV} GROUP BY 1)
  SELECT event_id, t - mid AS corrected_ns FROM {EV} JOIN m USING (event_type)""",
)
def c8_latency_correction(t: Tables):
    rows = t.events().withColumn("latency", F.col("value") * 1e6)
    return clocks.latency_corrected(rows, ["event_type"], "t", "latency").select(
        "event_id", "corrected_ns"
    )


@query(
    "c9_rebased_clock",
    f"""WITH m AS (SELECT user_id, min(t) AS f FROM {EV} GROUP BY 1)
  SELECT event_id, 1600000000000000000 + (t - f) AS rebased_ns FROM {EV} JOIN m USING (user_id)""",
)
def c9_rebased_clock(t: Tables):
    return clocks.rebased(
        t.events(), ["user_id"], "t", F.lit(1_600_000_000_000_000_000)
    ).select("event_id", "rebased_ns")


@query(
    "c10_live_skew",
    f"""WITH m AS (SELECT user_id, abs(max(CASE WHEN event_type = 'click' THEN t END)
    - max(CASE WHEN event_type = 'purchase' THEN t END)) / 1e9 AS s FROM {EV} GROUP BY 1)
  SELECT user_id, {q6("s")} AS skew_s, coalesce(s <= 86400, false) AS skew_ok FROM m""",
)
def c10_live_skew(t: Tables):
    out = clocks.live_skew(
        t.events(), ["user_id"], "event_type", "click", "purchase", "t", limit_s=86400
    )
    return out.select("user_id", r6("skew_s").alias("skew_s"), "skew_ok")


@query(
    "e4_match_anchor",
    f"""WITH a AS (SELECT user_id, min(t) AS t FROM {EV} WHERE event_type = 'view' GROUP BY 1),
  s AS (SELECT * FROM {EV} WHERE event_type = 'signup'),
  c AS (SELECT a.user_id, s.event_id, abs(s.t - a.t) AS d, row_number() OVER
    (PARTITION BY a.user_id ORDER BY abs(s.t - a.t), s.t) AS k FROM a JOIN s USING (user_id))
  SELECT a.user_id, c.event_id AS window_id, {q6("c.d / 1e6")} AS start_delta_ms,
    coalesce(c.d <= {6 * HOUR}, false) AS matched FROM a LEFT JOIN c
    ON a.user_id = c.user_id AND c.k = 1""",
)
def e4_match_anchor(t: Tables):
    anchors = t.events("view").groupBy("user_id").agg(F.min("t").alias("anchor"))
    out = clocks.match_anchor(
        anchors, t.events("signup"), ["user_id"], "anchor", "user_id", "t", "event_id",
        limit_ms=6 * HOUR / 1e6,
    )
    return out.select(
        "user_id",
        F.col("window.event_id").alias("window_id"),
        r6("start_delta_ms").alias("start_delta_ms"),
        "matched",
    )


def marks(t: Tables):
    """Signups and errors as start and stop events."""
    kind = F.when(F.col("event_type") == "signup", "record_start").otherwise("record_stop")
    return t.events("signup", "error").withColumn("kind", kind)


MARKS = f"""(SELECT *, CASE WHEN event_type = 'signup' THEN 'record_start' ELSE 'record_stop' END AS kind
  FROM {EV} WHERE event_type IN ('signup', 'error'))"""
# sessions are a user's half days, short enough for many of them to be clean
HALF_MARKS = f"(SELECT *, user_id * 1000 + (t // {12 * HOUR}) % 1000 AS session FROM {MARKS})"
PAIR_SQL = f"""r AS (SELECT session, kind, t, row_number() OVER
    (PARTITION BY session, kind ORDER BY t, event_id) AS k FROM {HALF_MARKS}),
  p AS (SELECT session, k, max(CASE WHEN kind = 'record_start' THEN t END) AS s,
    max(CASE WHEN kind = 'record_stop' THEN t END) AS e FROM r GROUP BY 1, 2),
  n AS (SELECT *, lead(s) OVER (PARTITION BY session ORDER BY k) AS nx FROM p),
  j AS (SELECT *, CASE WHEN s IS NULL OR e IS NULL THEN 1
    WHEN e <= s OR (e - s) / 1e9 > 36001 THEN 2 WHEN e >= nx THEN 3 END AS rule FROM n),
  bad AS (SELECT session, min(rule) AS rule, count(*) AS violations FROM j
    WHERE rule IS NOT NULL GROUP BY 1)"""


def half_day_marks(t: Tables):
    return marks(t).withColumn(
        "session", F.col("user_id") * 1000 + floor_div(F.col("t"), 12 * HOUR) % 1000
    )


@query(
    "e1_pair_start_stop",
    f"""WITH {PAIR_SQL} SELECT row_number() OVER (ORDER BY s, session) - 1 AS episode_index,
  session, s AS start_ns, e AS end_ns FROM j WHERE session NOT IN (SELECT session FROM bad)""",
)
def e1_pair_start_stop(t: Tables):
    good, _ = episodes.pair_start_stop(
        half_day_marks(t), "session", "kind", "t", "event_id", max_duration_s=36000
    )
    return good


@query(
    "e1_pairing_violations",
    f"""WITH {PAIR_SQL} SELECT session, CASE rule WHEN 1 THEN 'unmatched_events'
  WHEN 2 THEN 'invalid_duration' ELSE 'overlap' END AS reason, violations FROM bad""",
)
def e1_pairing_violations(t: Tables):
    _, bad = episodes.pair_start_stop(
        half_day_marks(t), "session", "kind", "t", "event_id", max_duration_s=36000
    )
    return bad


WALK_SQL = f"""n AS (SELECT session, kind, t, lead(kind) OVER w AS nk, lead(t) OVER w AS nt
    FROM {HALF_MARKS} WINDOW w AS (PARTITION BY session ORDER BY t, event_id)),
  s AS (SELECT *, CASE WHEN nk IS NULL THEN 'open' WHEN nk = 'record_start' THEN 'nested_start'
    WHEN nt <= t THEN 'no_length' ELSE 'closed' END AS st FROM n WHERE kind = 'record_start'),
  bad AS (SELECT session FROM s WHERE st IN ('nested_start', 'no_length'))"""


@query(
    "e2_closed_windows",
    f"""WITH {WALK_SQL} SELECT session, t AS start_ns, nt AS end_ns FROM s
  WHERE st = 'closed' AND session NOT IN (SELECT session FROM bad)""",
)
def e2_closed_windows(t: Tables):
    windows, _ = episodes.closed_windows(
        half_day_marks(t), "session", "kind", ["t", "event_id"], "t"
    )
    return windows


@query(
    "e3_fallback_episodes",
    f"""WITH a AS (SELECT user_id, t, event_type = 'view' AND value > 40 AS act FROM {EV})
  SELECT user_id, coalesce(min(t) FILTER (act), min(t)) AS start_ns,
    coalesce(max(t) FILTER (act), max(t)) AS end_ns,
    CASE WHEN bool_or(act) THEN 'recording_flag' ELSE 'full_available_range' END AS source
  FROM a GROUP BY 1""",
)
def e3_fallback_episodes(t: Tables):
    views = t.events("view").withColumn("active", F.col("value") > 40)
    others = [t.events("click"), t.events("purchase", "signup", "error")]
    return episodes.fallback_episodes(views, others, ["user_id"], "t", "active")


THRESHOLD = f"""th AS (SELECT user_id, min(value) + (max(value) - min(value)) * 0.15 AS thr
  FROM {EV} GROUP BY 1)"""
START = f"""es AS (SELECT user_id, min(CASE WHEN value <= thr THEN t END) AS f
  FROM {EV} JOIN th USING (user_id) GROUP BY 1)"""


@query(
    "e8_closed_threshold",
    f"WITH {THRESHOLD} SELECT user_id, {q6('thr')} AS closed_threshold FROM th",
)
def e8_closed_threshold(t: Tables):
    out = episodes.closed_threshold(t.events(), ["user_id"], "value")
    return out.select("user_id", r6("closed_threshold").alias("closed_threshold"))


def starts(t: Tables):
    rows = t.events()
    return episodes.effective_start(
        rows, episodes.closed_threshold(rows, ["user_id"], "value"), ["user_id"], "t", "value",
        3 * HOUR,
    )


@query(
    "e7_effective_start",
    f"""WITH {THRESHOLD}, {START} SELECT user_id, f AS first_closed, f + {3 * HOUR} AS effective_start,
  CASE WHEN f IS NULL THEN 'no_close_event' ELSE 'ok' END AS status FROM es""",
)
def e7_effective_start(t: Tables):
    return starts(t)


@query(
    "e9_effective_end",
    f"""WITH {THRESHOLD}, {START},
  w AS (SELECT a.user_id, a.event_id, a.t, count(*) AS n, avg(b.value) AS mv,
      avg(b.event_id % 10) AS mr
    FROM {EV} a JOIN {EV} b ON a.user_id = b.user_id AND b.t BETWEEN a.t AND a.t + {12 * HOUR}
    GROUP BY 1, 2, 3),
  s AS (SELECT w.user_id, w.event_id, w.t, any_value(n) AS n, max(abs(b.value - mv)) AS rv,
      max(abs(b.event_id % 10 - mr)) AS rr
    FROM w JOIN {EV} b ON w.user_id = b.user_id AND b.t BETWEEN w.t AND w.t + {12 * HOUR}
    GROUP BY 1, 2, 3),
  f AS (SELECT s.user_id, min(s.t) AS t FROM s JOIN es USING (user_id)
    WHERE s.t >= es.f + {3 * HOUR} + {DAY} AND n > 1 AND rv < 8 AND rr < 4 GROUP BY 1),
  l AS (SELECT user_id, max(t) AS t FROM {EV} GROUP BY 1)
  SELECT l.user_id, coalesce(f.t, l.t) AS effective_end, CASE WHEN f.t IS NULL
    THEN 'fallback_end_of_sequence' ELSE 'stable_pose_window' END AS status
  FROM l LEFT JOIN f USING (user_id)""",
)
def e9_effective_end(t: Tables):
    rows = t.events().withColumn("turn", (F.col("event_id") % 10).cast("double"))
    return episodes.effective_end(
        rows, starts(t), ["user_id"], "t", ["value"], ["turn"],
        window=12 * HOUR, min_duration=DAY, max_translation=8.0, max_rotation=4.0,
    )


SPACE = """SELECT user_id, event_id, t, value AS x, (event_id % 13)::DOUBLE AS y, (event_id * 7 % 11)::DOUBLE AS z,
  (event_id % 10)::DOUBLE AS turn FROM {}"""


@query(
    "e9_effective_end_in_space",
    f"""WITH {THRESHOLD}, {START}, p AS ({SPACE.format(EV)}),
  w AS (SELECT a.user_id, a.event_id, a.t, count(*) AS n, avg(b.x) AS mx, avg(b.y) AS my, avg(b.z) AS mz,
      avg(b.turn) AS mr
    FROM p a JOIN p b ON a.user_id = b.user_id AND b.t BETWEEN a.t AND a.t + {9 * HOUR} GROUP BY 1, 2, 3),
  s AS (SELECT w.user_id, w.event_id, w.t, any_value(n) AS n,
      max(sqrt(pow(b.x - mx, 2) + pow(b.y - my, 2) + pow(b.z - mz, 2))) AS rv, max(abs(b.turn - mr)) AS rr
    FROM w JOIN p b ON w.user_id = b.user_id AND b.t BETWEEN w.t AND w.t + {9 * HOUR} GROUP BY 1, 2, 3),
  f AS (SELECT s.user_id, min(s.t) AS t FROM s JOIN es USING (user_id)
    WHERE s.t >= es.f + {3 * HOUR} + {DAY} AND n > 1 AND rv < 9 AND rr < 4 GROUP BY 1),
  l AS (SELECT user_id, max(t) AS t FROM {EV} GROUP BY 1)
  SELECT l.user_id, coalesce(f.t, l.t) AS effective_end, CASE WHEN f.t IS NULL
    THEN 'fallback_end_of_sequence' ELSE 'stable_pose_window' END AS status
  FROM l LEFT JOIN f USING (user_id)""",
)
def e9_effective_end_in_space(t: Tables):
    """Three coordinates: bounds leave windows open, which exact distances settle."""
    rows = t.events().select(
        "user_id",
        "t",
        F.col("value").alias("x"),
        (F.col("event_id") % 13).alias("y"),
        (F.col("event_id") * 7 % 11).alias("z"),
        (F.col("event_id") % 10).alias("turn"),
    )
    return episodes.effective_end(
        rows, starts(t), ["user_id"], "t", ["x", "y", "z"], ["turn"],
        window=9 * HOUR, min_duration=DAY, max_translation=9.0, max_rotation=4.0,
    )


IDS = f"(SELECT event_id, CASE WHEN user_id > 0 AND user_id < 65535 THEN user_id ELSE 0 END AS ep FROM {EV})"


@query(
    "e10_episode_ends_at_changes",
    f"""WITH n AS (SELECT ep, row_number() OVER (ORDER BY event_id) AS k,
    lead(ep) OVER (ORDER BY event_id) AS nx FROM {IDS})
  SELECT ep, k AS episode_end FROM n WHERE nx IS NULL OR nx <> ep""",
)
def e10_episode_ends_at_changes(t: Tables):
    rows = episodes.clamp_episode_id(
        t.events().select("event_id", F.col("user_id").alias("ep")), "ep"
    )
    return episodes.ends_at_changes(rows, ["event_id"], "ep")


@query(
    "e11_episode_ends_by_id",
    f"""SELECT user_id, (sum(count(*)) OVER (ORDER BY user_id))::BIGINT AS episode_end
  FROM {EV} GROUP BY 1""",
)
def e11_episode_ends_by_id(t: Tables):
    return episodes.ends_by_id(t.events(), "user_id")


@query(
    "e12_cumulative_lengths",
    f"""WITH l AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS rgb,
    count(*) FILTER (event_type = 'purchase') AS wrench FROM {EV} GROUP BY 1)
  SELECT user_id, (sum(rgb) OVER (ORDER BY user_id))::BIGINT AS rgb_len,
    (sum(wrench) OVER (ORDER BY user_id))::BIGINT AS wrench_len FROM l""",
)
def e12_cumulative_lengths(t: Tables):
    lengths = t.events().groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("rgb"),
        F.count_if(F.col("event_type") == "purchase").alias("wrench"),
    )
    out = episodes.cumulative_lengths(lengths, [], ["user_id"], ["rgb", "wrench"])
    return out.select("user_id", "rgb_len", "wrench_len")


@query(
    "e13_preroll_slice",
    f"""WITH s AS (SELECT user_id, event_id AS start_id, t AS s FROM {EV} WHERE event_type = 'signup')
  SELECT e.event_id, s.start_id FROM {EV} e JOIN s ON e.user_id = s.user_id
    AND e.t BETWEEN s.s - {2 * HOUR} AND s.s + {4 * HOUR} WHERE e.event_type = 'view'""",
)
def e13_preroll_slice(t: Tables):
    marks_ = t.events("signup").select(
        "user_id",
        F.col("event_id").alias("start_id"),
        F.col("t").alias("start"),
        (F.col("t") + 4 * HOUR).alias("end"),
    )
    out = episodes.preroll_slice(
        t.events("view"), marks_, ["user_id"], "t", "start", "end", 2 * HOUR, DAY
    )
    return out.select("event_id", "start_id")


@query(
    "e14_manual_trim",
    f"""WITH ep AS (SELECT user_id, min(t) AS s, max(t) AS e FROM {EV} GROUP BY 1),
  o AS (SELECT user_id, user_id % 2 = 0 AS use, max(t) - {HOUR} AS e FROM {EV}
    WHERE event_type = 'error' GROUP BY 1)
  SELECT ep.user_id, ep.s, CASE WHEN o.use AND o.e IS NOT NULL THEN o.e ELSE ep.e END AS e
  FROM ep LEFT JOIN o USING (user_id)""",
)
def e14_manual_trim(t: Tables):
    ep = t.events().groupBy("user_id").agg(F.min("t").alias("s"), F.max("t").alias("e"))
    overrides = (
        t.events("error")
        .groupBy("user_id")
        .agg((F.max("t") - HOUR).alias("e"))
        .select(
            "user_id",
            (F.col("user_id") % 2 == 0).alias("use_manual_trim"),
            F.lit(None).cast("long").alias("s"),
            "e",
        )
    )
    return episodes.manual_trim(ep, overrides, ["user_id"], ["s", "e"])


CONNECTIONS = f"""(SELECT user_id, event_id AS f, event_id + (value * 3)::BIGINT AS l FROM {EV})"""


@query(
    "e15_archive_generations",
    f"""WITH g AS (SELECT *, max(l) OVER (PARTITION BY user_id ORDER BY f, l
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {CONNECTIONS}),
  m AS (SELECT *, greatest(0, coalesce(f - seen - 1, 0)) AS missing FROM g)
  SELECT user_id, f, l, missing AS missing_sequences,
    (sum(CASE WHEN missing > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY f, l))::BIGINT
    AS generation FROM m""",
)
def e15_archive_generations(t: Tables):
    connections = t.events().select(
        "user_id",
        F.col("event_id").alias("f"),
        (F.col("event_id") + F.rint(F.col("value") * 3).cast("long")).alias("l"),
    )
    return episodes.archive_generations(connections, "user_id", "f", "l")
