"""Queries: streaming operators over the events, replayed as micro-batches."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import asof, ordered, session
from braidline.operators import episodes
from braidline.ordered import floor_div
from braidline.queries.base import DAY, EV, HOUR, Tables, q6, query, r6
from braidline.queries.clocks import WALK_SQL, half_day_marks
from braidline.sources import sinks
from braidline.sources.episodes import EpisodeTable
from braidline.streaming import jobs, live, stateful

KEYS = ["user_id"]
DELAY = "3 days"


FEED_FILES = 4  # files of a delivery, written by as many tasks


def deliver(t: Tables, rows: DataFrame, delivery: Column, batches: int, label: str) -> DataFrame:
    """Rows as a stream of ``batches`` deliveries of FEED_FILES files each, in order."""
    path = session.scratch_path(t.spark, label)
    names = rows.columns
    dealt = rows.withColumn("_b", delivery)
    for b in range(batches):
        part = dealt.where(F.col("_b") == b).select(*names)
        part.repartition(FEED_FILES).write.mode("append").parquet(path)
    return stateful.read_batches(t.spark, path, rows.schema, FEED_FILES)


def replay(t: Tables, rows: DataFrame, batches: int = 4, jitter: int = DAY) -> DataFrame:
    """Rows as deliveries that overlap in time, read as a stream.

    A last delivery with one far later row lets the watermark pass all others.
    """
    low, high = rows.agg(F.min("t"), F.max("t")).first()
    width = (high - low) // batches + 1
    late = F.pmod(F.col("seq"), F.lit(3)) * jitter
    place = F.least(floor_div(F.col("t") - low + late, width), F.lit(batches - 1))
    nulls = {f.name: F.lit(None).cast(f.dataType) for f in rows.schema}
    end = {"user_id": F.lit(-1).cast("long"), "t": F.lit(high + 60 * DAY), "seq": F.lit(-1).cast("long")}
    beat = t.spark.range(1).select(*[{**nulls, **end}[f.name].alias(f.name) for f in rows.schema])
    both = rows.unionByName(beat)
    return deliver(t, both, F.when(F.col("seq") < 0, batches).otherwise(place), batches + 1, "feed")


def run(t: Tables, rows: DataFrame, step, output: str, label: str) -> DataFrame:
    stream = stateful.walk_stream(replay(t, rows), KEYS, "t", "seq", step, output, DELAY)
    return stateful.run_to_table(stream, label)


def frames(t: Tables) -> DataFrame:
    """Events as live frames, some of them without a pose or a gripper value."""
    e, v, k = F.col("event_id"), F.col("value"), F.col("event_type")
    return t.events().select(
        "user_id",
        "t",
        e.alias("seq"),
        F.when(k == "signup", "start")
        .when((k == "error") & (e % 10 == 0), "discard")
        .when((k == "error") & (e % 10 < 6), "stop")
        .otherwise("frame")
        .alias("kind"),
        floor_div(F.col("t"), 10 * DAY).alias("episode_index"),
        (e % 4 > 0).alias("recording"),
        (e % 20 > 0).alias("gate_ok"),
        F.when(k != "error", F.array(v, v * 2, v - 1)).alias("pos"),
        F.when(k == "error", "pose_invalid").alias("pos_reason"),
        F.when(k != "signup", F.when(v > 20, 1.0).otherwise(0.0)).alias("gripper_state"),
    )


@query(
    "t1_completed_steps",
    f"""WITH g AS (SELECT *, t // {10 * DAY} AS ep FROM {EV} WHERE event_id % 20 > 0),
  u AS (SELECT *, lag(t) OVER w AS pt, lag(ep) OVER w AS pe, lag(value) OVER w AS pv FROM g
    WHERE event_type NOT IN ('error', 'signup') WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
  SELECT user_id, pt AS from_ns, t AS to_ns, {q6("value - pv")} AS a0, NULL::VARCHAR AS dropped_reason FROM u WHERE pe = ep
  UNION ALL SELECT user_id, NULL, t, NULL, CASE WHEN event_type = 'error' THEN 'pose_invalid' ELSE 'gripper_invalid' END
    FROM g WHERE event_type IN ('error', 'signup')""",
)
def t1_completed_steps(t: Tables):
    out = run(t, frames(t), live.completed_steps, live.STEP_COLUMNS, "steps")
    return out.select(
        "user_id", "from_ns", "to_ns", r6(F.get("action", F.lit(0))).alias("a0"), "dropped_reason"
    )


@query(
    "t2_recorded_rows",
    f"""WITH k AS (SELECT *, t // {10 * DAY} AS ep, event_id % 4 > 0 AS rec, CASE WHEN event_type = 'signup' THEN 'start'
    WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'discard' WHEN event_type = 'error' AND event_id % 10 < 6 THEN 'stop'
    ELSE 'frame' END AS kind FROM {EV}),
  f AS (SELECT *, kind = 'frame' AND event_id % 20 > 0 AND event_type <> 'error' AS usable FROM k),
  s AS (SELECT *, sum((kind = 'start')::INT) OVER w AS number,
    last_value(CASE WHEN kind <> 'frame' THEN kind END IGNORE NULLS) OVER b AS control,
    last_value(CASE WHEN usable THEN t END IGNORE NULLS) OVER b AS pt, last_value(CASE WHEN usable THEN ep END IGNORE NULLS) OVER b AS pe,
    last_value(CASE WHEN usable THEN value END IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN usable THEN rec END IGNORE NULLS) OVER b AS pr
    FROM f WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id),
    b AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  c AS (SELECT *, row_number() OVER (PARTITION BY user_id, number, pt ORDER BY t, event_id) AS again FROM s
    WHERE usable AND pe = ep AND rec AND pr AND control = 'start'),
  r AS (SELECT user_id, number, pe AS episode_index, pt AS source_ns, t AS next_ns, 'completed' AS row_type, {q6("value - pv")} AS a0
      FROM c WHERE again = 1
    UNION ALL SELECT user_id, number, pe, pt, NULL, 'terminal', 0.0 FROM s WHERE kind = 'stop' AND control = 'start' AND pr
      AND NOT EXISTS (FROM c WHERE c.user_id = s.user_id AND c.number = s.number AND c.pt >= s.pt))
  SELECT user_id, number::BIGINT AS recording, episode_index, source_ns, next_ns, row_type, a0 FROM r
    WHERE (user_id, number) NOT IN (SELECT user_id, number FROM s WHERE kind = 'discard')""",
)
def t2_recorded_rows(t: Tables):
    out = run(t, frames(t), live.recorded_rows, live.RECORD_COLUMNS, "recorded")
    return live.without_discarded(out, KEYS).select(
        "user_id", "recording", "episode_index", "source_ns", "next_ns", "row_type",
        r6(F.get("action", F.lit(0))).alias("a0"),
    )


@query(
    "t3_preroll_flush",
    f"""WITH s AS (SELECT * FROM {EV} WHERE event_type = 'signup'),
  x AS (SELECT * FROM {EV} WHERE event_type <> 'signup')
  SELECT s.event_id AS event_seq, x.event_id AS sample_seq FROM s JOIN x ON s.user_id = x.user_id
    AND x.t >= s.t - {DAY} AND (x.t < s.t OR x.t = s.t AND x.event_id < s.event_id)""",
)
def t3_preroll_flush(t: Tables):
    rows = t.events().select(
        "user_id",
        "t",
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "signup", "start").otherwise("sample").alias("kind"),
    )
    out = run(t, rows, live.ring_buffer(3 * DAY, 0, DAY), live.RING_COLUMNS, "ring")
    return out.select("event_seq", "sample_seq")


LIMITS = {"phone": 2 * DAY, "camera": 5 * DAY // 2, "force": DAY}


def heartbeats(t: Tables) -> DataFrame:
    kinds = {"click": "phone", "error": "phone", "view": "camera", "purchase": "force", "signup": "check"}
    names = F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv])
    return t.events().select(
        "user_id",
        "t",
        F.col("event_id").alias("seq"),
        names[F.col("event_type")].alias("kind"),
        (F.col("event_id") % 7 > 0).alias("ok"),
        F.when(F.col("event_type") == "error", "link").alias("error"),
    )


def _gate_sql() -> str:
    parts = []
    for name, limit in LIMITS.items():
        parts.append(
            f"""CASE WHEN {name}_t IS NULL THEN '{name}_missing' END, CASE WHEN t - {name}_t > {limit} THEN '{name}_stale' END,
      CASE WHEN {name}_id % 7 = 0 THEN '{name}_not_ready' END, CASE WHEN {name}_k = 'error' THEN '{name}_error' END"""
        )
    cols = []
    for name, kinds in {"phone": "'click', 'error'", "camera": "'view'", "force": "'purchase'"}.items():
        for out, col in (("t", "t"), ("id", "event_id"), ("k", "event_type")):
            cols.append(
                f"last_value(CASE WHEN event_type IN ({kinds}) THEN {col} END IGNORE NULLS) OVER w AS {name}_{out}"
            )
    return f"""WITH s AS (SELECT *, {", ".join(cols)} FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
  r AS (SELECT event_id AS seq, concat_ws(',', {", ".join(parts)},
    CASE WHEN abs(phone_t - force_t) > {DAY} THEN 'clock_skew' END) AS reasons FROM s WHERE event_type = 'signup')
  SELECT seq, reasons = '' AS ready, reasons FROM r"""


@query("t4_freshness_gate", _gate_sql())
def t4_freshness_gate(t: Tables):
    step = live.freshness_gate(LIMITS, DAY, ("phone", "force"))
    return run(t, heartbeats(t), step, live.GATE_COLUMNS, "gate").select("seq", "ready", "reasons")


def linear_model(x):
    """A stand-in for the force network: three axes, sums of channels."""
    return x[:, :3] + x[:, 3:6]


CALIBRATION = live.CalibrationSettings(
    mean_delta=1e3, noise_std=1e3, passes=2, zero_limit_n=20.0, second_ns=12 * HOUR
)


def sensor_rows(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events().select(
        "user_id",
        "t",
        F.col("event_id").alias("seq"),
        F.lit("sample").alias("kind"),
        F.array(*[v * k for k in (1, 0.5, 0.25, 0.1, 0.2, 0.3)]).alias("raw"),
    )


# all channels are multiples of the value, so its windows tell those of all
T5_SQL = f"""WITH RECURSIVE r AS (SELECT user_id, event_id AS seq, t / {12 * HOUR} AS clk, value AS v,
    row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM {EV}),
  w AS (SELECT r.user_id, r.k, r.seq, r.clk, r.v, n.n >= 2 AND n.span >= 1.4 AS now_ok, n.m, n.sd,
    b.n >= 2 AND b.span >= 1.4 AS before_ok, b.m AS mb FROM r,
    LATERAL (SELECT count(*) AS n, avg(x.v) AS m, stddev_pop(x.v) AS sd, max(x.clk) - min(x.clk) AS span FROM r x
      WHERE x.user_id = r.user_id AND x.k <= r.k AND x.clk >= r.clk - 2) n,
    LATERAL (SELECT count(*) AS n, avg(x.v) AS m, max(x.clk) - min(x.clk) AS span FROM r x
      WHERE x.user_id = r.user_id AND x.k <= r.k AND x.clk >= r.clk - 4 AND x.clk <= r.clk - 2) b),
  s AS (SELECT user_id, k, seq, 'warming_up' AS st, clk AS started, NULL::DOUBLE AS checked, 0 AS passed, NULL::DOUBLE AS since,
      NULL::DOUBLE AS tare, 0 AS n, 0.0::DOUBLE AS sm, NULL::DOUBLE AS bias, NULL::DOUBLE AS zero FROM w WHERE k = 1
    UNION ALL SELECT user_id, k, seq,
      CASE WHEN early THEN CASE WHEN clk - started < 5 THEN 'warming_up' WHEN NOT due THEN st WHEN p >= 2 THEN 'provisional_tare' ELSE 'delayed' END
        WHEN st = 'provisional_tare' THEN 'runtime_settling'
        WHEN st = 'runtime_settling' THEN CASE WHEN settled THEN 'final_tare' ELSE st END
        WHEN biasing THEN CASE WHEN lasted THEN 'zero_check' ELSE 'bias_calibration' END
        WHEN st = 'zero_check' AND lasted THEN CASE WHEN 1.1 * abs(sn / nn - tare - bias) <= 20 THEN 'ready' ELSE 'zero_check_failed' END
        ELSE st END,
      started, CASE WHEN due THEN clk ELSE checked END, p,
      CASE WHEN st IN ('provisional_tare', 'final_tare') OR biasing AND lasted THEN clk ELSE since END,
      CASE WHEN settled THEN m ELSE tare END, CASE WHEN biasing AND lasted THEN 0 ELSE nn END,
      CASE WHEN biasing AND lasted THEN 0.0 ELSE sn END, CASE WHEN biasing AND lasted THEN sn / nn - tare ELSE bias END,
      CASE WHEN st = 'zero_check' AND lasted THEN 1.1 * abs(sn / nn - tare - bias) ELSE zero END
    FROM (SELECT *, CASE WHEN NOT due THEN passed WHEN now_ok AND before_ok AND abs(m - mb) <= 1000 AND 0.275 * sd <= 1000 THEN passed + 1
        ELSE 0 END AS p FROM
      (SELECT w.*, s.st, s.started, s.checked, s.passed, s.since, s.tare, s.bias, s.zero, s.st IN ('warming_up', 'delayed') AS early,
        s.st IN ('warming_up', 'delayed') AND w.clk - s.started >= 5 AND (s.checked IS NULL OR w.clk - s.checked >= 0.5) AS due,
        s.st = 'runtime_settling' AND w.clk - s.since >= 5 AND w.now_ok AS settled, s.st IN ('final_tare', 'bias_calibration') AS biasing,
        s.st <> 'final_tare' AND w.clk - s.since >= 1 AS lasted,
        CASE WHEN s.st = 'final_tare' THEN 1 ELSE s.n + 1 END AS nn, CASE WHEN s.st = 'final_tare' THEN w.v ELSE s.sm + w.v END AS sn
       FROM s JOIN w ON w.user_id = s.user_id AND w.k = s.k + 1)))
  SELECT user_id, seq, st AS status, st = 'ready' AS ready, {q6("zero")} AS zero_force FROM s"""


@query("t5_startup_calibration", T5_SQL)
def t5_startup_calibration(t: Tables):
    step = live.startup_calibration(CALIBRATION, linear_model)
    out = run(t, sensor_rows(t), step, live.CALIBRATION_COLUMNS, "calibration")
    return out.select("user_id", "seq", "status", "ready", r6("zero_force").alias("zero_force"))


@query(
    "t6_frame_assembly",
    f"""SELECT event_id AS seq, CASE WHEN event_id % 41 = 0 THEN 'missing_metadata'
    WHEN value > 20 AND value <= 25 THEN 'missing_depth'
    WHEN value < 20 AND event_id % 7 = 0 THEN 'unexpected_depth' END AS violation FROM {EV}""",
)
def t6_frame_assembly(t: Tables):
    """Three streams joined as they arrive."""
    e = t.events().withColumn("seq", F.col("event_id"))
    base = e.select("user_id", "seq", "t")
    meta = e.where(F.col("seq") % 41 != 0).select(
        "user_id", "seq", "t", (F.col("value") > 20).alias("depth_expected")
    )
    extra = (F.col("value") < 20) & (F.col("seq") % 7 == 0)
    depth = e.where((F.col("value") > 25) | extra).select("user_id", "seq", "t")
    joined = jobs.assemble_stream(
        *[replay(t, x, batches=2) for x in (base, meta, depth)], ["user_id", "seq"], DELAY
    )
    return stateful.run_to_table(joined, "assembly").where(F.col("seq") >= 0).select("seq", "violation")


@query(
    "t6_exactly_once_append",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM {EV})
  SELECT event_id, CASE WHEN k > 40 THEN 'after_error' WHEN k = 40 THEN 'gap' WHEN k % 6 = 0 THEN 'discarded' ELSE 'appended' END AS verdict FROM r""",
)
def t6_exactly_once_append(t: Tables):
    """Every sixth frame is the first one again, and the numbers jump at the 40th."""
    ranked = ordered.scan(t.events(), KEYS, ["t", "event_id"], k=ordered.RowNumber())
    k = F.col("k")
    number = k - floor_div(k, 6) + F.when(k >= 40, 2).otherwise(0)
    rows = ranked.select(
        "user_id",
        "t",
        F.col("event_id").alias("seq"),
        F.when(k % 6 == 0, F.lit(1)).otherwise(number).cast("long").alias("frame"),
        F.lit(None).cast("string").alias("violation"),
    )
    out = run(t, rows, live.exactly_once_append, live.APPEND_COLUMNS, "append")
    return out.select(F.col("seq").alias("event_id"), "verdict")


@query(
    "t7_sequence_monitor",
    f"""WITH s AS (SELECT event_id, user_id, t, CASE WHEN event_id % 17 = 0 THEN 4294967295 - event_id ELSE event_id END AS q FROM {EV}),
  g AS (SELECT event_id, ((q - lag(q) OVER w - 1) % 4294967296 + 4294967296) % 4294967296 AS g FROM s
    WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
  SELECT event_id AS seq, CASE WHEN g IS NULL THEN 0 WHEN g >= 1000000 THEN 1 ELSE g END AS dropped,
    coalesce(g >= 1000000, false) AS discarded FROM g""",
)
def t7_sequence_monitor(t: Tables):
    e = F.col("event_id")
    rows = t.events().select(
        "user_id",
        "t",
        e.alias("seq"),
        F.when(e % 17 == 0, F.lit(4294967295) - e).otherwise(e).alias("sequence"),
        floor_div(F.col("t"), 1000).alias("device_us"),
    )
    out = run(t, rows, live.sequence_monitor, live.MONITOR_COLUMNS, "monitor")
    return out.select("seq", "dropped", "discarded")


@query(
    "t8_rate_report",
    f"""SELECT event_type, epoch_us(time_bucket(INTERVAL 1 DAY, ts)) * 1000 AS window_start_ns, count(*) AS packets,
  {q6("count(*) / 86400")} AS rate_hz, {q6("sum(length(props)) * 8 / 86400 / 1e6")} AS mbps FROM events GROUP BY 1, 2""",
)
def t8_rate_report(t: Tables):
    rows = t.events().select(
        "user_id", "t", F.col("event_id").alias("seq"), "event_type", F.length("props").alias("size")
    )
    report = jobs.rate_report(replay(t, rows), ["event_type"], "t", "size", "1 day", DELAY)
    out = stateful.run_to_table(report, "rates").where(F.col("event_type").isNotNull())
    return out.select(
        "event_type", "window_start_ns", "packets", r6("rate_hz").alias("rate_hz"), r6("mbps").alias("mbps")
    )


TRANSITIONS = {
    "signup": "record_start_committed",
    "error": "record_stop_committed",
    "view": "record_start_requested",
    "click": "note",
    "purchase": "record_discard_committed",
}


@query(
    "t9_recording_transitions",
    f"""SELECT event_id AS event_seq, row_number() OVER w AS transition_seq,
  coalesce(last_value(CASE event_type WHEN 'signup' THEN 'active' WHEN 'error' THEN 'stopped' WHEN 'view' THEN 'starting'
    WHEN 'purchase' THEN 'discarded' END IGNORE NULLS) OVER w, 'idle') AS phase
  FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)""",
)
def t9_recording_transitions(t: Tables):
    names = F.create_map(*[F.lit(x) for kv in TRANSITIONS.items() for x in kv])
    rows = t.events().select(
        "user_id", "t", F.col("event_id").alias("seq"), names[F.col("event_type")].alias("event")
    )
    out = run(t, rows, live.recording_transitions, live.TRANSITION_COLUMNS, "transitions")
    return out.select("event_seq", "transition_seq", "phase")


@query(
    "t10_incremental_publish",
    f"""WITH {WALK_SQL}, w AS (SELECT session, t AS start_ns, nt AS end_ns
    FROM s WHERE st = 'closed' AND session NOT IN (SELECT session FROM bad))
  SELECT w.session, w.start_ns, e.event_id FROM w JOIN {EV} e ON e.user_id = w.session // 1000
    AND e.t BETWEEN w.start_ns AND w.end_ns WHERE e.event_type IN ('view', 'click', 'purchase')""",
)
def t10_incremental_publish(t: Tables):
    """Closed windows arrive as a stream; each batch publishes the samples of its episodes."""
    windows, _ = episodes.closed_windows(
        half_day_marks(t), "session", "kind", ["t", "event_id"], "t"
    )
    numbered = ordered.scan(
        windows.select("session", "start_ns", "end_ns"), ["session"], ["start_ns", "end_ns"],
        nth=ordered.RowNumber(),
    )
    closed = numbered.select("session", "nth", "start_ns", "end_ns")
    stream = deliver(t, closed, F.pmod(F.col("session"), F.lit(2)), 2, "closed")
    out = session.scratch_path(t.spark, "published")
    samples = t.events("view", "click", "purchase")

    def publish(batch):
        rows = asof.windows_join(
            samples,
            batch.withColumn("user_id", floor_div(F.col("session"), 1000)),
            KEYS, "t", "start_ns", "end_ns", DAY,
        )
        # an episode's id holds its session and its place there
        episode = F.concat_ws("-", "session", "nth")
        sinks.write_episodes(
            rows.select(
                F.lit("live").alias("run_id"), episode.alias("source_episode_index"),
                "session", "start_ns", "event_id", "t",
            ),
            out,
        )

    keys = ["session", "nth"]
    stateful.run_batches(stream, "publish", jobs.publish_closed(t.spark, publish, keys))
    return EpisodeTable(t.spark, out).read().select("session", "start_ns", "event_id")


T11_SQL = f"""WITH r AS (SELECT user_id % 5 AS session, event_id AS seq, t, event_type, value,
    event_id * 20000000 AS phone, 2000000000000 + event_id * 19999000 AS host FROM {EV}),
  lim AS (SELECT min(t) AS lo, max(t) AS hi FROM r),
  p AS (SELECT r.*, event_type = 'view' AND t >= lo + (hi - lo) // 4 AS is_clock,
    least((t - lo + (seq % 3) * {DAY}) // ((hi - lo) // 4 + 1), 3) AS b,
    host + round_even(value * 100000, 0)::BIGINT AS receive FROM r, lim),
  c AS (SELECT batch, session, seq, phone, host + (seq * 37) % 1000 AS host,
      200000 + round_even(value * 5000, 0)::BIGINT AS rtt
    FROM p JOIN (SELECT unnest(range(4)) AS batch) ON b <= batch WHERE is_clock),
  k AS (SELECT *, row_number() OVER (PARTITION BY batch, session ORDER BY rtt, seq) AS k,
    count(*) OVER (PARTITION BY batch, session) AS n FROM c),
  s AS (SELECT * FROM k WHERE k <= least(n, greatest(8, ceil(n * 0.2)))),
  l AS (SELECT batch, session, count(*) AS m, max(phone) - min(phone) AS span,
    regr_slope(host::DOUBLE, phone::DOUBLE) AS slope, avg(phone::DOUBLE) AS mx, avg(host::DOUBLE) AS my
    FROM s GROUP BY 1, 2),
  l2 AS (SELECT *, coalesce(m >= 4 AND span >= 2000000000 AND slope BETWEEN 0.999 AND 1.001, false) AS fit FROM l),
  l3 AS (SELECT *, CASE WHEN fit THEN slope ELSE 1.0 END AS scale FROM l2),
  md AS (SELECT batch, session, median((host - my) - scale * (phone - mx)) AS mid
    FROM s JOIN l3 USING (batch, session) GROUP BY 1, 2),
  m AS (SELECT *, my - scale * mx + mid AS off FROM l3 JOIN md USING (batch, session)),
  w AS (SELECT batch, session, min(receive - phone) AS one_way
    FROM p JOIN (SELECT unnest(range(4)) AS batch) ON b <= batch WHERE NOT is_clock GROUP BY 1, 2)
  SELECT p.session, seq, CASE WHEN m.session IS NULL THEN 'one_way_min_delay' WHEN fit
      THEN 'bidirectional_affine_low_rtt' ELSE 'bidirectional_offset' END AS alignment_method,
    CASE WHEN m.session IS NULL THEN 'estimating' ELSE 'receiver_aligned' END AS status,
    round_even((CASE WHEN m.session IS NULL THEN phone + one_way
      ELSE round_even(scale * phone + off, 0)::BIGINT END - host) / 1e5, 0)::BIGINT AS off_by
  FROM p JOIN w ON p.session = w.session AND p.b = w.batch
    LEFT JOIN m ON p.session = m.session AND p.b = m.batch WHERE NOT is_clock"""


@query("t11_live_clock_mapping", T11_SQL)
def t11_live_clock_mapping(t: Tables):
    """Clock samples and frames of a session as one stream; the last deliveries are fully aligned.

    ``off_by`` is what aligned times are off the host's, in tenths of a millisecond.
    """
    e = F.col("event_id")
    host = F.lit(2_000_000_000_000) + e * 19_999_000
    # clock samples start after the first quarter of the time
    low, high = t.events().agg(F.min("t"), F.max("t")).first()
    warm = low + (high - low) // 4
    rows = t.events().select(
        "user_id",
        F.pmod(F.col("user_id"), F.lit(5)).alias("session"),
        "t",
        e.alias("seq"),
        F.when((F.col("event_type") == "view") & (F.col("t") >= warm), "clock")
        .otherwise("frame")
        .alias("kind"),
        (e * 20_000_000).alias("phone_ns"),
        (host + (e * 37) % 1000).alias("host_ns"),
        (F.lit(200_000) + F.rint(F.col("value") * 5000).cast("long")).alias("rtt_ns"),
        (e * 20_000_000).alias("capture_ns"),
        (host + F.rint(F.col("value") * 100_000).cast("long")).alias("receive_ns"),
    )
    paths = [session.scratch_path(t.spark, n) for n in ("clock", "offsets", "mapped")]
    stream = replay(t, rows)
    stateful.run_batches(
        stream.where(F.col("user_id") >= 0),
        "clock",
        jobs.live_clock_mapping(t.spark, ["session"], *paths),
    )
    out = t.spark.read.option("basePath", paths[2]).parquet(paths[2])
    true = F.lit(2_000_000_000_000) + F.col("seq") * 19_999_000
    off_by = F.rint((F.col("aligned_ns") - true) / 1e5).cast("long")
    return out.select("session", "seq", "alignment_method", "status", off_by.alias("off_by"))


