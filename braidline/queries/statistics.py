"""Queries: aggregates, gates, catalogs and models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from braidline import ordered, session
from braidline.operators import gates, model, statistics
from braidline.plans import alignment, formats, postprocess, training
from braidline.queries.base import DAY, EV, HOUR, VEC, Tables, q6, query, r6, stamp, stamp_sql
from braidline.queries.joins import TIMELINE_CTE, timeline
from braidline.sources.episodes import EpisodeTable

KEYS = ["user_id"]
ORDER = ["t", "event_id"]


@query(
    "a3_status_histogram",
    f"""SELECT user_id, coalesce(CASE WHEN event_id % 5 > 0 THEN event_type END, 'unknown') AS status, count(*) AS n
  FROM {EV} GROUP BY 1, 2""",
)
def a3_status_histogram(t: Tables):
    rows = t.events().withColumn("s", F.when(F.col("event_id") % 5 > 0, F.col("event_type")))
    return statistics.status_histogram(rows, KEYS, "s")


# frame numbers per user: the running event id, now and then repeated or missing
NUMBERS = f"""(SELECT user_id, t, event_id, CASE WHEN event_id % 11 > 0 THEN event_id - (event_id % 13 = 0)::INT * 500 END AS c,
  CASE WHEN event_id % 7 > 0 THEN event_id * 2 END AS d FROM {EV})"""


def numbered(t: Tables):
    e = F.col("event_id")
    return t.events().select(
        "user_id",
        "t",
        "event_id",
        F.when(e % 11 > 0, e - (e % 13 == 0).cast("long") * 500).alias("c"),
        F.when(e % 7 > 0, e * 2).alias("d"),
    )


def _side_sql(c: str) -> str:
    return f"""(SELECT user_id, coalesce(sum(CASE WHEN {c} > p + 1 THEN {c} - p - 1 END), 0)::BIGINT AS m,
      count(*) FILTER ({c} <= p) AS o, min_by({c}, event_id) AS f, max_by({c}, event_id) AS l
    FROM (SELECT user_id, event_id, {c}, lag({c}) OVER (PARTITION BY user_id ORDER BY t, event_id) AS p
      FROM {NUMBERS} WHERE {c} IS NOT NULL) GROUP BY 1)"""


@query(
    "a4_frame_integrity",
    f"""SELECT c.user_id, c.m AS color_missing, c.o AS color_out_of_order, c.f AS color_first, c.l AS color_last,
    d.m AS depth_missing, d.o AS depth_out_of_order, d.f AS depth_first, d.l AS depth_last,
    greatest(c.m, d.m) AS missing_frames, greatest(c.o, d.o) AS out_of_order_frames
  FROM {_side_sql("c")} c JOIN {_side_sql("d")} d USING (user_id)""",
)
def a4_frame_integrity(t: Tables):
    return statistics.frame_integrity(numbered(t), KEYS, ORDER, {"color": "c", "depth": "d"})


@query(
    "a4_integrity_total",
    f"""SELECT c.user_id % 10 AS run, sum(greatest(c.m, d.m))::BIGINT AS missing_frames,
    sum(greatest(c.o, d.o))::BIGINT AS out_of_order_frames,
    sum(greatest(c.m, d.m)) = 0 AND sum(greatest(c.o, d.o)) = 0 AS ok
  FROM {_side_sql("c")} c JOIN {_side_sql("d")} d USING (user_id) GROUP BY 1""",
)
def a4_integrity_total(t: Tables):
    per = statistics.frame_integrity(numbered(t), KEYS, ORDER, {"color": "c", "depth": "d"})
    return statistics.integrity_total(per.withColumn("run", F.col("user_id") % 10), ["run"])


@query(
    "a5_sequence_gaps",
    f"""WITH s AS (SELECT user_id, CASE WHEN event_id % 17 = 0 THEN 4294967295 - event_id ELSE event_id END AS q,
      t, event_id FROM {EV}),
  g AS (SELECT user_id, ((q - lag(q) OVER w - 1) % 4294967296 + 4294967296) % 4294967296 AS g FROM s
    WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
  SELECT user_id, coalesce(sum(CASE WHEN g < 1000000 THEN g END), 0)::BIGINT AS dropped,
    count(*) FILTER (g >= 1000000) AS out_of_order FROM g GROUP BY 1""",
)
def a5_sequence_gaps(t: Tables):
    e = F.col("event_id")
    rows = t.events().withColumn("q", F.when(e % 17 == 0, F.lit(4294967295) - e).otherwise(e))
    return statistics.sequence_gaps(rows, KEYS, ORDER, "q")


@query(
    "a6_stream_summary",
    f"""WITH s AS (SELECT *, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY t, event_id) AS j FROM {EV})
  SELECT user_id, count(*) AS frames, count(*) FILTER (value > 10) AS pose_valid,
    count(*) FILTER (event_type = 'view') AS gripper_valid, count(*) FILTER (event_id % 3 = 0) AS rgb_valid,
    coalesce(sum(CASE WHEN j <> 1 THEN greatest(1, j - 1) END), 0)::BIGINT AS dropped,
    {q6("count(*) / ((max(t) - min(t)) / 1e9)")} AS capture_fps, {q6("min(value)")} AS open_min, {q6("max(value)")} AS open_max,
    {q6("avg(value * 2)")} AS age_mean_ms, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tracking_states
  FROM s GROUP BY 1""",
)
def a6_stream_summary(t: Tables):
    frames = t.events().select(
        "user_id",
        "t",
        "event_id",
        F.col("event_id").alias("sequence"),
        (F.col("value") > 10).alias("pose_valid"),
        (F.col("event_type") == "view").alias("gripper_valid"),
        (F.col("event_id") % 3 == 0).alias("rgb_valid"),
        F.col("value").alias("open_percent"),
        (F.col("value") * 2).alias("gripper_age_ms"),
        F.col("event_type").alias("tracking"),
    )
    out = statistics.stream_summary(frames, KEYS, ORDER)
    return out.select(
        "user_id", "frames", "pose_valid", "gripper_valid", "rgb_valid", "dropped",
        *[r6(c).alias(c) for c in ("capture_fps", "open_min", "open_max", "age_mean_ms")],
        "tracking_states",
    )


A7_SQL = f"""SELECT event_type, {q6("quantile_cont(value, 0.5)")} AS p50, {q6("quantile_cont(value, 0.95)")} AS p95,
  {q6("quantile_cont(value, 0.99)")} AS p99 FROM {EV} GROUP BY 1"""


def _a7(t: Tables, rows_per_task=None):
    out = ordered.percentiles(
        t.events(), ["event_type"], "value", rows_per_task, p50=0.5, p95=0.95, p99=0.99
    )
    return out.select("event_type", *[r6(c).alias(c) for c in ("p50", "p95", "p99")])


@query("a7_percentiles", A7_SQL)
def a7_percentiles(t: Tables):
    return _a7(t)


@query("a7_percentiles_cut_keys", A7_SQL)
def a7_percentiles_cut_keys(t: Tables):
    return _a7(t, 200)


@query(
    "a8_minmax_normalizer",
    f"""SELECT {q6("min(value)")} AS value_min, {q6("max(value)")} AS value_max, 7.0::DOUBLE AS flat_min,
  8.0::DOUBLE AS flat_max FROM {EV}""",
)
def a8_minmax_normalizer(t: Tables):
    rows = t.events().withColumn("flat", F.lit(7.0))
    out = statistics.minmax(rows, [], ["value", "flat"])
    return out.select(*[r6(c).alias(c) for c in out.columns])


SPLIT = "CASE label % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END"


def split(t: Tables):
    name = F.when(F.col("label") % 3 == 0, "train").when(F.col("label") % 3 == 1, "val")
    return t.vectors().select(
        "vec_id",
        name.otherwise(F.lit("test")).alias("split"),
        F.get("e", F.lit(0)).alias("c0"),
        F.get("e", F.lit(1)).alias("c1"),
        F.lit(3.0).alias("c2"),
    )


@query(
    "a9_zscored",
    f"""WITH s AS (SELECT avg(e[1]) AS m, stddev_pop(e[1]) AS d, avg(e[2]) AS m1, stddev_pop(e[2]) AS d1 FROM {VEC} WHERE {SPLIT} = 'train')
  SELECT vec_id, {q6("(e[1] - m) / d")} AS z0, {q6("(e[2] - m1) / d1")} AS z1, 0.0::DOUBLE AS z2 FROM {VEC}, s""",
)
def a9_zscored(t: Tables):
    out = statistics.zscored(split(t), "split", ["c0", "c1", "c2"])
    return out.select("vec_id", *[r6(f"c{i}_z").alias(f"z{i}") for i in range(3)])


@query(
    "a10_split_from_name",
    f"""SELECT vec_id, CASE vec_id % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'val' WHEN 2 THEN 'test' END AS split FROM {VEC}""",
)
def a10_split_from_name(t: Tables):
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in ("_train.h5", "_val.h5", "_test.h5", "_other.h5")]),
        (F.col("vec_id") % 4 + 1).cast("int"),
    )
    name = F.concat(F.lit("run"), F.col("vec_id").cast("string"), suffix)
    return t.vectors().select("vec_id", statistics.split_from_name(name).alias("split"))


@query(
    "a11_error_metrics",
    f"""SELECT label, {q6("avg((e[1] - e[2]) ** 2)")} AS mse, {q6("sqrt(avg((e[1] - e[2]) ** 2))")} AS rmse,
  {q6("1 - sum((e[1] - e[2]) ** 2) / sum((e[1] - m) ** 2)")} AS r2
  FROM (SELECT *, avg(e[1]) OVER (PARTITION BY label) AS m FROM {VEC}) GROUP BY 1""",
)
def a11_error_metrics(t: Tables):
    rows = t.vectors().select(
        "label", F.get("e", F.lit(0)).alias("y"), F.get("e", F.lit(1)).alias("p")
    )
    out = statistics.error_metrics(rows, ["label"], "y", "p")
    return out.select("label", *[r6(c).alias(c) for c in ("mse", "rmse", "r2")])


@query(
    "a12_quadratic_fit",
    f"""SELECT label, feature::INTEGER AS feature, axis::INTEGER AS axis, n AS rows_used, 0.0::DOUBLE AS slope
  FROM (SELECT label, count(*) AS n FROM {VEC} WHERE label IS NOT NULL GROUP BY 1),
    range(24) f(feature), range(6) x(axis)""",
)
def a12_quadratic_fit(t: Tables):
    """A fit is the least one if its residuals are orthogonal to every feature, in every group."""
    rows = t.vectors().where("label IS NOT NULL").select(
        "vec_id", "label", F.slice("e", 1, 12).alias("c"), F.slice("e", 13, 6).alias("w")
    )
    fit = statistics.quadratic_fit(rows, ["label"], "c", "w")
    scored = rows.join(fit, "label").select(
        "label",
        "rows_used",
        F.posexplode(statistics.quadratic_features(F.col("c"))).alias("feature", "x"),
        F.zip_with(
            "w", statistics.quadratic_apply(F.col("c"), F.col("coefficients")), lambda a, b: a - b
        ).alias("r"),
        "w",
    )
    tall = scored.select("label", "rows_used", "feature", "x", F.posexplode(F.arrays_zip("r", "w")).alias("axis", "v"))
    sums = tall.groupBy("label", "rows_used", "feature", "axis").agg(
        F.sum(F.col("x") * F.col("v.r")).alias("xr"),
        F.sum(F.col("x") * F.col("x")).alias("xx"),
        F.sum(F.col("v.w") * F.col("v.w")).alias("ww"),
    )
    slope = F.coalesce(F.col("xr") / F.nullif(F.sqrt(F.col("xx") * F.col("ww")), F.lit(0.0)), F.lit(0.0))
    # without a negative zero
    return sums.select("label", "feature", "axis", "rows_used", (r6(slope) + F.lit(0.0)).alias("slope"))


@query(
    "a13_tare_offsets",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM {EV})
  SELECT user_id, {q6("CASE WHEN max(k) >= 60 THEN avg(value) FILTER (k > 10 AND k <= 60) END")} AS value_offset,
    CASE WHEN max(k) >= 60 THEN 'ok' ELSE 'too_few_samples' END AS status FROM r GROUP BY 1""",
)
def a13_tare_offsets(t: Tables):
    out = statistics.tare_offsets(t.events(), KEYS, ORDER, ["value"], 10, 60)
    return out.select("user_id", r6("value_offset").alias("value_offset"), "status")


@query(
    "a14_first_row_baseline",
    f"""SELECT event_id, {q6("value - (SELECT min_by(value, event_id) FROM events)")} AS value FROM {EV}""",
)
def a14_first_row_baseline(t: Tables):
    out = statistics.first_row_baseline(t.events(), ["event_id"], ["value"])
    return out.select("event_id", r6("value").alias("value"))


@query(
    "a15_export_quality",
    f"""{TIMELINE_CTE} SELECT user_id, count(*) AS timeline_rows, count(*) FILTER (all_valid) AS exported_rows,
  {q6("avg(all_valid::INT)")} AS exported_ratio, {q6("avg(camera_valid::INT)")} AS camera_ratio FROM tl GROUP BY 1""",
)
def a15_export_quality(t: Tables):
    out = gates.export_quality(
        timeline(t), KEYS, {"camera": F.col("camera.valid")}, F.col("all_valid")
    )
    return out.select(
        "user_id", "timeline_rows", "exported_rows",
        r6("exported_ratio").alias("exported_ratio"), r6("camera_ratio").alias("camera_ratio"),
    )


@query(
    "a16_normalization_gate",
    f"""WITH r AS (SELECT user_id, count(*) FILTER (event_type = 'view' AND value > 40) AS f,
    count(*) FILTER (event_type = 'signup' AND value > 50) AS ev, count(*) FILTER (event_type = 'click' AND value > 40) AS c,
    bool_and(event_id % 50 <> 0) AS ok, count(*) FILTER (event_type = 'purchase') AS s,
    count(*) FILTER (event_type = 'purchase' AND value > 60) AS cs FROM {EV} GROUP BY 1),
  x AS (SELECT user_id, concat_ws(',', CASE WHEN f <= 0 THEN 'frames_missing' END,
    CASE WHEN ev <> 2 THEN 'not_one_start_stop_pair' END, CASE WHEN c <= 0 THEN 'camera_frames_missing' END,
    CASE WHEN NOT ok THEN 'camera_discontinuous' END, CASE WHEN s <= 0 THEN 'force_samples_missing' END,
    CASE WHEN cs <= 0 THEN 'calibrated_samples_missing' END) AS reasons FROM r)
  SELECT user_id, reasons = '' AS ok, reasons FROM x""",
)
def a16_normalization_gate(t: Tables):
    def n(kind, low=-1.0):
        return F.count_if((F.col("event_type") == kind) & (F.col("value") > low))

    report = t.events().groupBy("user_id").agg(
        n("view", 40).alias("frames"),
        n("signup", 50).alias("events"),
        n("click", 40).alias("camera_frames"),
        F.bool_and(F.col("event_id") % 50 != 0).alias("camera_ok"),
        n("purchase").alias("samples"),
        n("purchase", 60).alias("calibrated_samples"),
    )
    return gates.normalization_gate(report, KEYS)


@query(
    "a17_alignment_gate",
    f"""{TIMELINE_CTE}, cnt AS (SELECT user_id, count(*) AS n, count(*) FILTER (camera_valid) AS cv,
    count(*) FILTER (force_valid) AS fv, count(*) FILTER (all_valid) AS av,
    count(CASE WHEN camera_valid THEN camera_id END) - count(DISTINCT CASE WHEN camera_valid THEN camera_id END) AS d
    FROM tl GROUP BY 1),
  x AS (SELECT *, concat_ws(',', CASE WHEN cv / n < 0.3 THEN 'camera_valid_ratio_low' END,
    CASE WHEN fv / n < 0.3 THEN 'force_valid_ratio_low' END, CASE WHEN av / n < 0.3 THEN 'all_valid_ratio_low' END,
    CASE WHEN d / n > 0.05 THEN 'duplicate_targets' END) AS reasons FROM cnt)
  SELECT user_id, {q6("cv / n")} AS camera_valid_ratio, {q6("d / n")} AS duplicate_ratio, reasons = '' AS ok, reasons FROM x""",
)
def a17_alignment_gate(t: Tables):
    tl = timeline(t)
    source = F.when(F.col("camera.valid"), F.col("camera.row.event_id"))
    counts = tl.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("timeline_rows"),
        F.count_if("camera.valid").alias("camera_valid"),
        F.count_if("force.valid").alias("force_valid"),
        F.count_if("all_valid").alias("all_valid"),
        (F.count(source) - F.count_distinct(source)).alias("duplicate_targets"),
    )
    out = gates.alignment_gate(
        counts, KEYS, ["camera_valid", "force_valid", "all_valid"], min_ratio=0.3
    )
    return out.select(
        "user_id",
        r6("camera_valid_ratio").alias("camera_valid_ratio"),
        r6("duplicate_ratio").alias("duplicate_ratio"),
        "ok",
        "reasons",
    )


@query(
    "a18_media_gate",
    f"""WITH r AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS n,
    count(*) FILTER (event_type = 'view' AND value < 5) AS a, count(*) FILTER (event_type = 'view' AND value > 30) AS b
    FROM {EV} GROUP BY 1),
  x AS (SELECT *, concat_ws(',', CASE WHEN n <= 0 THEN 'no_image_rows' END,
    CASE WHEN n > 0 AND a / n > 0.2 THEN 'rgb_missing_ratio_high' END,
    CASE WHEN n > 0 AND b / n > 0.2 THEN 'depth_missing_ratio_high' END) AS reasons FROM r)
  SELECT user_id, {q6("a / n")} AS rgb_missing_ratio, {q6("b / n")} AS depth_missing_ratio, reasons = '' AS ok, reasons FROM x""",
)
def a18_media_gate(t: Tables):
    view = F.col("event_type") == "view"
    counts = t.events().groupBy("user_id").agg(
        F.count_if(view).alias("n"),
        F.count_if(view & (F.col("value") < 5)).alias("rgb_missing"),
        F.count_if(view & (F.col("value") > 30)).alias("depth_missing"),
    )
    out = gates.media_gate(counts, KEYS, "n", ["rgb_missing", "depth_missing"])
    return out.select(
        "user_id",
        r6("rgb_missing_ratio").alias("rgb_missing_ratio"),
        r6("depth_missing_ratio").alias("depth_missing_ratio"),
        "ok",
        "reasons",
    )


@query(
    "a19_input_gate",
    f"""WITH s AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS a, count(*) FILTER (event_type = 'click') AS b,
    count(*) FILTER (event_type = 'purchase') AS c FROM {EV} WHERE value > 45 GROUP BY 1),
  x AS (SELECT user_id, concat_ws(',', CASE WHEN a = 0 THEN 'missing_view' END, CASE WHEN b = 0 THEN 'missing_click' END,
    CASE WHEN c = 0 THEN 'missing_purchase' END) AS reasons FROM s)
  SELECT user_id, reasons = '' AS ok, reasons FROM x""",
)
def a19_input_gate(t: Tables):
    rows = t.events().where(F.col("value") > 45)
    return gates.input_gate(rows, KEYS, "event_type", ["view", "click", "purchase"])


@query(
    "a20_export_gate",
    f"""WITH m AS (SELECT user_id, count(*) AS n FROM {EV} WHERE value > 120 GROUP BY 1),
  w AS (SELECT DISTINCT user_id FROM {EV})
  SELECT user_id, coalesce(n, 0) AS mappings, coalesce(n, 0) = 1 AS ok,
    CASE WHEN n IS NULL THEN 'not_mapped' WHEN n > 1 THEN 'mapped_twice' ELSE '' END AS reasons FROM w LEFT JOIN m USING (user_id)""",
)
def a20_export_gate(t: Tables):
    manifest = t.events().where(F.col("value") > 120)
    out = gates.export_gate(t.events(), manifest, KEYS)
    return out.withColumn("mappings", F.col("mappings").cast("long"))


@query(
    "a21_dataset_catalog",
    f"""WITH r AS (SELECT c_custkey AS run, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS n FROM customer),
  e AS (SELECT o_custkey AS run, count(DISTINCT o_orderkey) AS c, max(o_orderkey) AS l FROM orders GROUP BY 1),
  x AS (SELECT o_custkey AS run, count(DISTINCT o_orderpriority) AS c FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
  u AS (SELECT o_custkey AS run, max(o_totalprice) AS u FROM orders GROUP BY 1)
  SELECT run, coalesce(r.n, run::VARCHAR) AS display_name, coalesce(e.c, 0) AS episode_count,
    e.l AS latest_source_episode_index, coalesce(x.c, 0) AS export_count,
    CASE WHEN run % 4 = 0 THEN 'done' ELSE 'idle' END AS status, coalesce(u.u, 0.0) AS updated
  FROM r LEFT JOIN e USING (run) LEFT JOIN x USING (run) LEFT JOIN u USING (run)""",
)
def a21_dataset_catalog(t: Tables):
    orders = t.orders().withColumnRenamed("o_custkey", "run")
    updated = orders.groupBy("run").agg(F.max("o_totalprice").alias("updated_at"))
    key = F.col("c_custkey")
    runs = (
        t.table("customer")
        .select(
            key.alias("run"),
            F.when(key % 3 != 0, F.col("c_name")).alias("display_name"),
            F.lit(None).cast("string").alias("task_name"),
            F.when(key % 4 == 0, "done").alias("status"),
            F.lit(0.0).alias("created_at"),
        )
        .join(updated, "run", "left")
    )
    episodes = orders.select("run", F.col("o_orderkey").alias("source_episode_index"))
    exports = orders.where(F.col("o_orderstatus") == "F").select(
        "run", F.col("o_orderpriority").alias("path")
    )
    return gates.dataset_catalog(runs, episodes, exports, "run")


@query(
    "a22_array_lengths",
    f"""WITH l AS (SELECT user_id, event_type, count(*) // 8 AS n FROM {EV} GROUP BY 1, 2),
  g AS (SELECT user_id, list_sort(list(DISTINCT n)) AS l FROM l GROUP BY 1)
  SELECT user_id, CASE WHEN len(l) > 1 THEN 'review' ELSE 'ok' END AS status, array_to_string(l, ',') AS lengths FROM g""",
)
def a22_array_lengths(t: Tables):
    sizes = (
        t.events()
        .groupBy("user_id", "event_type")
        .agg(ordered.floor_div(F.count(F.lit(1)), 8).alias("n"))
    )
    return statistics.array_lengths(sizes, KEYS, "n")


@query(
    "a24_demo_checks",
    f"""SELECT vec_id, vec_id % 4 = 0 AS ok, concat_ws(',', CASE WHEN vec_id % 4 = 1 THEN 'frame_count' END,
    CASE WHEN vec_id % 4 = 2 THEN 'not_increasing' END, CASE WHEN vec_id % 4 = 3 THEN 'transform_shape' END) AS errors,
  {q6("CASE WHEN vec_id % 4 <> 2 THEN label + 1 END")} AS duration_s, {q6("CASE WHEN vec_id % 4 <> 2 THEN 1 END")} AS fps FROM {VEC}""",
)
def a24_demo_checks(t: Tables):
    """Every vector is a demo of label + 2 poses; one check breaks per residue of its id."""
    c = F.col("vec_id") % 4
    eye = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(4)]) for i in range(4)])
    rows = t.vectors().withColumn(
        "p", F.transform(F.sequence(F.lit(0), F.col("label") + 1), lambda i: i.cast("double"))
    )
    missing = F.lit(None).cast("array<double>")
    demos = rows.select(
        "vec_id",
        F.when(c == 2, F.reverse("p")).otherwise(F.col("p")).alias("pose_times"),
        F.transform("p", lambda _: F.when(c == 3, F.slice(eye, 1, 3)).otherwise(eye)).alias(
            "pose_transforms"
        ),
        F.when(c == 1, F.slice("p", F.lit(2), F.size("p"))).otherwise(F.col("p")).alias("frame_times"),
        missing.alias("depth_times"),
        missing.alias("widths"),
    )
    out = statistics.demo_checks(demos, "vec_id")
    return out.select(
        "vec_id", "ok", "errors", r6("duration_s").alias("duration_s"), r6("fps").alias("fps")
    )


@query(
    "a25_opening_scores",
    f"""WITH w AS (SELECT user_id, event_id, CASE WHEN event_type = 'view' THEN value END AS w FROM {EV}),
  s AS (SELECT user_id, count(w) AS n, min(w) AS lo, max(w) AS hi FROM w GROUP BY 1)
  SELECT event_id, {q6('''CASE WHEN w IS NULL THEN NULL WHEN n < 2 OR hi - lo < 1e-9 THEN 0
    ELSE greatest(0, least(100, (w - lo) / (hi - lo) * 100)) END''')} AS score FROM w JOIN s USING (user_id)""",
)
def a25_opening_scores(t: Tables):
    rows = t.events().withColumn("w", F.when(F.col("event_type") == "view", F.col("value")))
    return statistics.opening_scores(rows, KEYS, "w").select("event_id", r6("score").alias("score"))


BAND = """WITH r AS (SELECT vec_id, e[1] AS lx, 0.07 + e[2] / 20 AS lz, e[3] AS rx, 0.07 + e[4] / 20 AS rz FROM {v}),
  m AS (SELECT median((lz + rz) / 2) AS z FROM r),
  s AS (SELECT vec_id, CASE WHEN lz > z - 0.008 AND lz < z + 0.008 THEN lx END AS l,
    CASE WHEN rz > z - 0.008 AND rz < z + 0.008 THEN rx END AS x FROM r, m)""".format(v=VEC)


@query(
    "a26_marker_width",
    f"""{BAND} SELECT vec_id, {q6("CASE WHEN l IS NOT NULL AND x IS NOT NULL THEN x - l WHEN l IS NOT NULL THEN abs(l) * 2 ELSE abs(x) * 2 END")} AS width FROM s""",
)
def a26_marker_width(t: Tables):
    e = [F.get("e", F.lit(i)) for i in range(4)]
    rows = t.vectors().select(
        "vec_id",
        e[0].alias("left_x"),
        (F.lit(0.07) + e[1] / 20).alias("left_z"),
        e[2].alias("right_x"),
        (F.lit(0.07) + e[3] / 20).alias("right_z"),
    )
    rows = rows.withColumn("z", (F.col("left_z") + F.col("right_z")) / 2)
    out = statistics.banded_marker_width(rows, [], "z")
    return out.select("vec_id", r6("width").alias("width"))


@query(
    "a27_sweep_calibration",
    f"""WITH r AS (SELECT user_id, value * 3 AS d, value AS x, row_number() OVER w AS k, count(*) OVER (PARTITION BY user_id) AS n
    FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY value * 3, event_id)),
  b AS (SELECT *, least(greatest(10, n // 6), greatest(10, n // 3)) AS b FROM r)
  SELECT user_id, count(*) AS samples, CASE WHEN count(*) < 20 THEN 'too_few_samples' WHEN max(d) - min(d) < 80
    THEN 'range_too_small' ELSE 'ok' END AS status, {q6("avg(d) FILTER (k <= b)")} AS closed_d, {q6("avg(x) FILTER (k > n - b)")} AS open_x
  FROM b GROUP BY 1""",
)
def a27_sweep_calibration(t: Tables):
    rows = t.events().select(
        "user_id", "event_id", (F.col("value") * 3).alias("d"), F.col("value").alias("x")
    )
    out = statistics.sweep_calibration(rows, KEYS, "d", "event_id", ["x"])
    return out.select(
        "user_id", "samples", "status", r6("closed_d").alias("closed_d"), r6("open_x").alias("open_x")
    )


@query(
    "a28_sweep_cycles",
    f"""WITH d AS (SELECT user_id, t, event_id, least(value, 40) AS d FROM {EV}),
  s AS (SELECT user_id, min(d) AS lo, max(d) - min(d) AS sp FROM d GROUP BY 1),
  z AS (SELECT user_id, t, event_id, CASE WHEN sp < 12 THEN NULL WHEN d <= lo + sp * 0.28 THEN -1 WHEN d >= lo + sp * 0.72 THEN 1 END AS z
    FROM d JOIN s USING (user_id)),
  c AS (SELECT user_id, z <> lag(z) OVER (PARTITION BY user_id ORDER BY t, event_id) AS ch FROM z WHERE z IS NOT NULL)
  SELECT s.user_id, coalesce(n, 0.0)::DOUBLE AS cycles FROM s LEFT JOIN
    (SELECT user_id, count(*) FILTER (ch) / 2.0::DOUBLE AS n FROM c GROUP BY 1) USING (user_id)""",
)
def a28_sweep_cycles(t: Tables):
    rows = t.events().withColumn("d", F.least("value", F.lit(40.0)))
    return statistics.sweep_cycles(rows, KEYS, ORDER, "d")


@query(
    "a29_age_summary",
    f"""SELECT user_id, {q6("max(abs(value - 20))")} AS age_max, {q6("quantile_cont(abs(value - 20), 0.95)")} AS age_p95 FROM {EV} GROUP BY 1""",
)
def a29_age_summary(t: Tables):
    rows = t.events().withColumn("age", F.col("value") - 20)
    out = statistics.age_summary(rows, KEYS, "age")
    return out.select("user_id", r6("age_max").alias("age_max"), r6("age_p95").alias("age_p95"))


@query(
    "a30_field_differences",
    """WITH s AS (SELECT c_custkey AS k, c_mktsegment AS a, c_nationkey::VARCHAR AS b FROM customer),
  c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'X' ELSE c_mktsegment END AS a,
    CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN (c_nationkey + 1)::VARCHAR ELSE c_nationkey::VARCHAR END AS b FROM customer)
  SELECT s.k, 'a' AS field, s.a AS expected, c.a AS actual FROM s JOIN c USING (k) WHERE s.a <> c.a
  UNION ALL SELECT s.k, 'b', s.b, c.b FROM s JOIN c USING (k) WHERE s.b <> c.b""",
)
def a30_field_differences(t: Tables):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    base = t.table("customer")
    stored = base.select(k.alias("k"), F.col("c_mktsegment").alias("a"), n.alias("b"))
    current = base.select(
        k.alias("k"),
        F.when(k % 5 == 0, "X").otherwise(F.col("c_mktsegment")).alias("a"),
        F.when(k % 7 != 0, F.when(k % 3 == 0, n + 1).otherwise(n)).alias("b"),
    )
    return statistics.field_differences(stored, current, ["k"], ["a", "b"])


@query(
    "a31_raw_stability",
    f"""WITH e AS (SELECT user_id, max(t) AS x FROM {EV} GROUP BY 1),
  c AS (SELECT user_id, t, unnest([value, value * 2, event_id::DOUBLE % 7]) AS v, unnest([0, 1, 2]) AS ch FROM {EV}),
  p AS (SELECT user_id, ch, avg(v) FILTER (t >= x - {7 * DAY} AND t <= x) AS m1,
    avg(v) FILTER (t >= x - {14 * DAY} AND t <= x - {7 * DAY}) AS m0,
    stddev_pop(v) FILTER (t >= x - {7 * DAY} AND t <= x) AS sd FROM c JOIN e USING (user_id) WHERE t >= x - {14 * DAY} GROUP BY 1, 2),
  g AS (SELECT user_id, max(abs(m1 - m0)) AS d, median(sd) AS n FROM p GROUP BY 1)
  SELECT user_id, {q6("d")} AS mean_delta, {q6("n")} AS noise_std, coalesce(d <= 8 AND n <= 20, false) AS stable FROM g""",
)
def a31_raw_stability(t: Tables):
    v = F.col("value")
    rows = t.events().withColumn("ch", F.array(v, v * 2, (F.col("event_id") % 7).cast("double")))
    last = rows.groupBy("user_id").agg(F.max("t").alias("x"))
    out = statistics.raw_stability(rows.join(last, "user_id"), KEYS, "t", F.col("x"), 7 * DAY, "ch")
    return out.select(
        "user_id", r6("mean_delta").alias("mean_delta"), r6("noise_std").alias("noise_std"), "stable"
    )


@query(
    "a32_zero_check",
    f"""SELECT label, {q6("greatest(abs(avg(e[1])), abs(avg(e[2])), abs(avg(e[3])))")} AS max_abs_force,
  greatest(abs(avg(e[1])), abs(avg(e[2])), abs(avg(e[3]))) <= 0.02 AS ok FROM {VEC} GROUP BY 1""",
)
def a32_zero_check(t: Tables):
    rows = t.vectors().select("label", *[F.get("e", F.lit(i)).alias(f"f{i}") for i in range(3)])
    out = statistics.zero_check(rows, ["label"], ["f0", "f1", "f2"], limit=0.02)
    return out.select("label", r6("max_abs_force").alias("max_abs_force"), "ok")


@query(
    "a33_buffer_stats",
    f"""WITH r AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t) AS k, count(*) OVER p AS n, max(t) OVER p AS l
    FROM {EV} WINDOW p AS (PARTITION BY user_id)),
  m AS (SELECT *, t >= l - {5 * DAY} AND k > n - 10 AS kept FROM r)
  SELECT user_id, count(*) FILTER (kept) AS count, {q6("(max(t) FILTER (kept) - min(t) FILTER (kept)) / 1e9")} AS span_s,
    min(t) FILTER (kept) AS first_ns, max(t) FILTER (kept) AS latest_ns, count(*) AS appended,
    count(*) FILTER (NOT kept) AS pruned FROM m GROUP BY 1""",
)
def a33_buffer_stats(t: Tables):
    out = statistics.buffer_stats(t.events(), KEYS, "t", 5 * DAY, 10)
    return out.withColumn("span_s", r6("span_s"))


@query(
    "a34_seeded_split",
    f"""WITH p AS (SELECT event_id, ('0x' || substr(md5('7:' || event_id::VARCHAR), 1, 8))::BIGINT / 4294967296 AS p FROM {EV})
  SELECT event_id, CASE WHEN p < 0.64 THEN 'train' WHEN p < 0.8 THEN 'val' ELSE 'test' END AS split FROM p""",
)
def a34_seeded_split(t: Tables):
    return t.events().select(
        "event_id", statistics.seeded_split(F.col("event_id"), 7).alias("split")
    )


@query(
    "a37_max_force",
    f"""WITH f AS (SELECT user_id, event_id, t, CASE WHEN event_id % 5 > 0 THEN greatest(abs(value - 30), abs(20 - value), abs(value / 2)) END AS f FROM {EV})
  SELECT event_id, {q6("f")} AS force, {q6(f"max(f) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN {12 * HOUR} PRECEDING AND CURRENT ROW)")} AS recent_max FROM f""",
)
def a37_max_force(t: Tables):
    v, zero = F.col("value"), F.lit(0.0)
    left = F.array(v - 30, v / 2, zero, v * 9, zero, zero)
    right = F.when(F.col("event_id") % 5 > 0, F.array(F.lit(20.0) - v, zero, zero, zero, zero, zero))
    rows = t.events().withColumn("force", statistics.max_abs_force(left, right))
    out = statistics.trailing_max_force(rows, KEYS, "t", "force", 12 * HOUR)
    return out.select("event_id", r6("force").alias("force"), r6("recent_max").alias("recent_max"))


# ---------------------------------------------------------------------------
# models and training tables


def _channels(t: Tables):
    return t.vectors().select(
        "vec_id",
        F.when(F.col("vec_id") % 2 == 0, "left").otherwise("right").alias("side"),
        (F.col("label") % 2).alias("device"),
        F.slice("e", 1, 12).alias("c"),
        *[F.get("e", F.lit(i)).alias(f"c{i + 1}") for i in range(12)],
    )



def _linear(seed: int) -> model.ForceModel:
    """A net of one layer, whose result SQL can compute."""
    w = (np.arange(72).reshape(12, 6) % 5 - 2 + seed) / 8.0
    z = np.zeros
    return model.ForceModel(
        (w.astype("float32"),), (z(6, dtype="float32"),), z(12), np.ones(12), np.full(6, 0.5), np.full(6, 2.0)
    )


def _linear_sql(seed: int, axis: int) -> str:
    w = (np.arange(72).reshape(12, 6) % 5 - 2 + seed) / 8.0
    return "(" + " + ".join(f"e[{i + 1}] * {w[i, axis]}::DOUBLE" for i in range(12)) + ") * 2 + 0.5"


@query(
    "m1_force_model_linear",
    f"""SELECT vec_id, {stamp_sql("vec_id")} AS stamp, {", ".join(
        f"round(CASE WHEN vec_id % 2 = 0 THEN {_linear_sql(0, i)} ELSE {_linear_sql(1, i)} END, 3) AS {axis}"
        for i, axis in enumerate(model.AXES))} FROM {VEC}""",
)
def m1_force_model_linear(t: Tables):
    scored = model.predict_wrench(
        _channels(t).withColumn("stamp", stamp("vec_id")),
        "side",
        "c",
        {"left": _linear(0), "right": _linear(1)},
    )
    axes = [F.round(F.get("wrench", F.lit(i)), 3).alias(a) for i, a in enumerate(model.AXES)]
    return scored.select("vec_id", "stamp", *axes)


def _rule(seed: int) -> model.ForceModel:
    """A net of the full size whose weights follow from their place, as in ``_net_sql``."""
    layers = model.LAYERS
    weights = []
    for k, (a, b) in enumerate(zip(layers, layers[1:])):
        i, j = np.indices((a, b))
        weights.append((((7 * i + 13 * j + 5 * k + seed) % 17 - 8) / 32.0).astype("float32"))
    biases = tuple(np.full(b, 1 / 64, dtype="float32") for b in layers[1:])
    n, m = layers[0], layers[-1]
    return model.ForceModel(tuple(weights), biases, np.zeros(n), np.ones(n), np.zeros(m), np.full(m, 2.0))


RULED = {"left": _rule(1), "right": _rule(2)}


def _net_sql(h: str, seed: str) -> str:
    """The same net over a list of 12 numbers."""
    for k, (a, b) in enumerate(zip(model.LAYERS, model.LAYERS[1:])):
        total = (
            f"list_sum(list_transform(range({a}), lambda i: h[i + 1] * ((7 * i + 13 * j + {5 * k} + seed) % 17 - 8)"
            " / 32.0::DOUBLE)) + 1 / 64.0::DOUBLE"
        )
        if k < len(model.LAYERS) - 2:
            total = f"greatest({total}, 0.0::DOUBLE)"
        h = f"(SELECT *, list_transform(range({b}), lambda j: {total}) AS h{k + 1} FROM {h})"
        h = h.replace("h[i", f"h{k}[i")
    return h


@query(
    "m1_calibrated_wrench",
    f"""WITH r AS (SELECT vec_id, label % 2 AS device, vec_id % 2 + 1 AS seed, e,
    row_number() OVER (PARTITION BY label % 2, vec_id % 2 ORDER BY vec_id) AS k FROM {VEC}),
  o AS (SELECT device, seed, list_transform(range(12), lambda c: list_avg(list_transform(es, lambda e: e[c + 1]))) AS o
    FROM (SELECT device, seed, list(e ORDER BY k) AS es FROM r WHERE k > 5 AND k <= 30 GROUP BY 1, 2)),
  z AS (SELECT r.*, list_transform(range(12), lambda c: (e[c + 1] - o[c + 1])::FLOAT::DOUBLE) AS h0
    FROM r JOIN o ON r.device IS NOT DISTINCT FROM o.device AND r.seed = o.seed WHERE k >= 30),
  w AS (SELECT vec_id, {", ".join(f"avg(h6[{i + 1}] * 2) OVER v AS {a}" for i, a in enumerate(model.AXES))}
    FROM {_net_sql("z", "seed")}
    WINDOW v AS (PARTITION BY device, seed ORDER BY k ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
  SELECT vec_id, CASE WHEN seed = 1 THEN 'left' ELSE 'right' END AS side,
    CASE WHEN k >= 30 THEN 'ok' ELSE 'tare_pending' END AS calibration_status, least(k, 30) AS tare_count,
    {", ".join(f"{q6(f'w.{a}')} AS {a}" for a in model.AXES)}
  FROM r LEFT JOIN w USING (vec_id)""",
)
def m1_calibrated_wrench(t: Tables):
    """Tare, the whole network, moving average, per device and side."""
    out = model.calibrated_wrench(
        _channels(t), ["device"], "side", ["vec_id"], [f"c{i}" for i in range(1, 13)], RULED,
        tare_samples=30, ignored_samples=5,
    )
    return out.select(
        "vec_id", "side", "calibration_status", "tare_count", *[r6(a).alias(a) for a in model.AXES]
    )


def robot_rows(t: Tables):
    """Views as robot frames: a turn about the first axis, width from the value."""
    c, s = F.cos(F.radians("value")), F.sin(F.radians("value"))
    zero, one = F.lit(0.0), F.lit(1.0)
    m = F.array(
        F.array(one, zero, zero, F.col("value")),
        F.array(zero, c, -s, F.lit(2.0)),
        F.array(zero, s, c, F.lit(3.0)),
        F.array(zero, zero, zero, one),
    )
    rows = t.events("view").withColumn("m", m)
    start = t.events().groupBy("user_id").agg(F.min("t").alias("start"))
    return rows.join(start, "user_id")


def robot(t: Tables):
    return training.robot_table(
        robot_rows(t), ["user_id", "event_id"], "t", "start", "m", "value", []
    )


@query(
    "x18_robot_table",
    f"""WITH s AS (SELECT user_id, min(t) AS s FROM {EV} GROUP BY 1)
  SELECT event_id, {q6("(t - s) / 1e9")} AS seconds, {q6("value + 0.039711")} AS x,
    {q6("2 + cos(radians(value)) * (-0.094423) - sin(radians(value)) * (-0.257957)")} AS y,
    {q6("least(1, CASE WHEN value > 1 THEN value / 100 ELSE value END) * 0.08")} AS gripper
  FROM {EV} JOIN s USING (user_id) WHERE event_type = 'view'""",
)
def x18_robot_table(t: Tables):
    return robot(t).select(
        "event_id",
        r6("seconds").alias("seconds"),
        r6(F.get("ts_pose_fb", F.lit(0))).alias("x"),
        r6(F.get("ts_pose_fb", F.lit(1))).alias("y"),
        r6("gripper").alias("gripper"),
    )


@query(
    "x16_command_columns",
    f"""SELECT event_id, {q6("value + 0.039711")} AS command_x, {q6("value + 0.039711")} AS target_x, 40.0::DOUBLE AS stiffness
  FROM {EV} WHERE event_type = 'view'""",
)
def x16_command_columns(t: Tables):
    out = training.with_commands(robot(t), "ts_pose_fb", stiffness=40.0)
    return out.select(
        "event_id",
        r6(F.get("ts_pose_command", F.lit(0))).alias("command_x"),
        r6(F.get("ts_pose_virtual_target", F.lit(0))).alias("target_x"),
        "stiffness",
    )


@query(
    "x17_wrench_table",
    f"""WITH g AS (SELECT user_id, t, event_id, least(1, CASE WHEN value > 1 THEN value / 100 ELSE value END) * 0.08 AS w
    FROM {EV} WHERE event_type = 'view'),
  p AS (SELECT * FROM {EV} WHERE event_type = 'purchase'),
  j AS (SELECT p.event_id, p.t, p.value AS f, b.t AS bt, b.w AS bw, a.t AS ta, a.w AS aw
    FROM p ASOF LEFT JOIN g b ON p.user_id = b.user_id AND p.t >= b.t ASOF LEFT JOIN g a ON p.user_id = a.user_id AND p.t <= a.t),
  w AS (SELECT *, CASE WHEN bt IS NULL THEN aw WHEN ta IS NULL OR ta = bt THEN bw
    ELSE bw + (aw - bw) * ((t - bt)::DOUBLE / (ta - bt)) END AS w FROM j)
  SELECT event_id, {q6("f * 3")} AS fx, {q6("f * 6 + (f * (-0.081) - f * 2 * 0.166)")} AS mx,
    {q6("f * 5 + (f * 3 * 0.166 - f * w / 2)")} AS my, 12::BIGINT AS n FROM w""",
)
def x17_wrench_table(t: Tables):
    v = F.col("value")
    wrenches = t.events("purchase").select(
        "user_id",
        "event_id",
        "t",
        F.array(*[v * k for k in range(1, 7)]).alias("left"),
        F.array(*[v * 0.5] * 6).alias("right"),
    )
    out = training.wrench_table(
        wrenches, robot(t), KEYS, "t", "event_id", "event_id", "left", "right"
    )
    return out.select(
        "event_id",
        r6(F.get("left_tool", F.lit(0))).alias("fx"),
        r6(F.get("left_tool", F.lit(3))).alias("mx"),
        r6(F.get("left_tool", F.lit(4))).alias("my"),
        F.size("concat_tool").cast("long").alias("n"),
    )


K5_SQL = f"""SELECT event_id, {q6("value")} AS pos0, {q6("coalesce(lead(value) OVER w - value, 0)")} AS action0,
  CASE WHEN value / 100 >= 0.2 OR value <= 1 AND value >= 0.2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS gripper_state,
  coalesce(lead(CASE WHEN value / 100 >= 0.2 OR value <= 1 AND value >= 0.2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) OVER w,
    CASE WHEN value / 100 >= 0.2 OR value <= 1 AND value >= 0.2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS gripper_action
  FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)"""


def flat(t: Tables):
    v, zero = F.col("value"), F.lit(0.0)
    return training.flat_table(
        t.events(), KEYS, ORDER, F.array(v, v * 2, zero, zero, zero, zero),
        F.array(*[v] * 6), v, threshold=0.2,
    )


@query("k5_flat_training_table", K5_SQL)
def k5_flat_training_table(t: Tables):
    return flat(t).select(
        "event_id",
        r6(F.get("pos", F.lit(0))).alias("pos0"),
        r6(F.get("action", F.lit(0))).alias("action0"),
        "gripper_state",
        "gripper_action",
    )


@query(
    "gated_training_rows",
    f"""{TIMELINE_CTE}, good AS (SELECT user_id FROM tl GROUP BY 1 HAVING avg(camera_valid::INT) >= 0.15
    AND avg(force_valid::INT) >= 0.15 AND avg(all_valid::INT) >= 0.15
    AND (count(*) - count(DISTINCT event_id - event_id % (1 + user_id % 2))) / count(*) <= 0.05),
  x AS (SELECT tl.* FROM tl JOIN good USING (user_id) WHERE all_valid)
  SELECT event_id, {q6("left0")} AS pos0, {q6("coalesce(lead(left0) OVER w - left0, 0)")} AS action0 FROM x
  WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)""",
)
def gated_training_rows(t: Tables):
    """Align, gate, and export: the written timeline feeds the gate and the table."""
    tl = session.materialise(t.spark, timeline(t), "timeline")
    # every other user's events share a frame with their neighbour
    source = F.col("event_id") - F.col("event_id") % (1 + F.col("user_id") % 2)
    reused = tl.groupBy(*KEYS).agg(
        (F.count(F.lit(1)) - F.count_distinct(source)).alias("duplicate_targets")
    )
    counts = alignment.alignment_counts(tl, KEYS).join(reused, KEYS)
    verdicts = gates.alignment_gate(
        counts, KEYS, ["camera_valid", "force_valid", "all_valid"], min_ratio=0.15
    )
    kept = gates.passing(tl, verdicts, KEYS).where("all_valid")
    pos = F.transform("force.left_wrench", lambda x: F.rint(x * 1e6) / 1e6)
    rows = training.flat_table(kept, KEYS, ORDER, pos, F.col("force.left_wrench"), F.lit(1.0))
    return rows.select(
        "event_id",
        r6(F.get("pos", F.lit(0))).alias("pos0"),
        r6(F.get("action", F.lit(0))).alias("action0"),
    )


@query(
    "a16_gate_states",
    f"""WITH c AS (SELECT user_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
    count(*) FILTER (event_type = 'purchase') AS buys FROM {EV} GROUP BY 1)
  SELECT user_id AS episode_index, CASE WHEN views < 11 THEN 'normalization' WHEN clicks < 10 THEN 'alignment'
      WHEN buys < 12 THEN 'media' ELSE 'complete' END AS state,
    CASE WHEN views < 11 THEN 'few_views' WHEN clicks < 10 THEN 'few_clicks' WHEN buys < 12 THEN 'few_buys' ELSE '' END AS reasons
  FROM c""",
)
def a16_gate_states(t: Tables):
    """The first gate in order that refuses an episode, from the verdicts of all gates."""
    of = {"media": ("purchase", 12, "few_buys"), "alignment": ("click", 10, "few_clicks"),
          "normalization": ("view", 11, "few_views")}
    counts = t.events().groupBy(F.lit("r").alias("run_id"), F.col("user_id").alias("episode_index")).agg(
        *[F.count_if(F.col("event_type") == kind).alias(gate) for gate, (kind, _, _) in of.items()]
    )
    verdicts = F.array(
        *[
            F.struct(
                F.lit(gate).alias("gate"),
                (F.col(gate) >= least).alias("ok"),
                F.when(F.col(gate) < least, F.lit(reason)).otherwise("").alias("reasons"),
            )
            for gate, (_, least, reason) in of.items()
        ],
        F.struct(F.lit("export").alias("gate"), F.lit(True).alias("ok"), F.lit("").alias("reasons")),
    )
    states = postprocess.episode_states(counts.select("run_id", "episode_index", F.inline(verdicts)))
    return states.drop("run_id")


FORMAT_COLUMNS = {
    "episode": ["user_id"], "time": "t", "seq": "event_id", "matrix": "m", "opening": {"column": "value"},
}


def _format_timeline(t: Tables):
    v = F.col("value")
    return robot_rows(t).withColumns(
        {"force": F.struct(F.array(*[v * k for k in range(1, 7)]).alias("left_wrench"),
                           F.array(*[v * 0.5] * 6).alias("right_wrench"))}
    )


@query(
    "m2_flat_training_format",
    f"""WITH g AS (SELECT user_id, event_id, t, value, CASE WHEN value / 100 >= 0.3 OR value <= 1 AND value >= 0.3
    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS s FROM {EV} WHERE event_type = 'view'),
  p AS (SELECT *, atan2(sin(radians(value)), cos(radians(value))) AS roll FROM g)
  SELECT user_id, event_id, {q6("value * 1000")} AS x, {q6("roll")} AS roll,
    {q6("coalesce((lead(value) OVER w - value) * 1000, 0)")} AS dx, {q6("value * 3")} AS force_z, s AS gripper_state,
    coalesce(lead(s) OVER w, s) AS gripper_action, dense_rank() OVER (ORDER BY user_id) - 1 AS episode_index
  FROM p WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)""",
)
def m2_flat_training_format(t: Tables):
    """The shipped flat format over a timeline with other column names, written and read back."""
    path = session.scratch_path(t.spark, "formats")
    named = FORMAT_COLUMNS | {"opening": {"column": "value", "threshold": 0.3}}
    formats.shipped().write("flat_training", _format_timeline(t), path, named | {"left": "force.left_wrench"})
    rows = EpisodeTable(t.spark, f"{path}/flat_training", ["user_id"]).read()
    return rows.select(
        "user_id",
        "event_id",
        r6(F.get("pos", F.lit(0))).alias("x"),
        r6(F.get("pos", F.lit(3))).alias("roll"),
        r6(F.get("action", F.lit(0))).alias("dx"),
        r6(F.get(F.get("force", F.lit(0)), F.lit(2))).alias("force_z"),
        "gripper_state",
        "gripper_action",
        "episode_index",
    )


@query(
    "m2_replay_format",
    f"""WITH s AS (SELECT user_id, min(t) AS s, count(*) AS n FROM {EV} WHERE event_type = 'view' GROUP BY 1),
  g AS (SELECT user_id, event_id, t, value AS f, (t - s) / 1e9 AS seconds, n,
    least(1, CASE WHEN value > 1 THEN value / 100 ELSE value END) * 0.08 AS w
    FROM {EV} JOIN s USING (user_id) WHERE event_type = 'view')
  SELECT user_id, event_id, {q6("seconds")} AS seconds, {q6("f + 0.039711")} AS x, {q6("w")} AS gripper,
    25.0::DOUBLE AS stiffness, {q6("f + 0.039711")} AS command_x, {q6("f * 3")} AS fx,
    {q6("f * 5 + (f * 3 * 0.166 - f * w / 2)")} AS my, n AS robot_len, n AS wrench_len FROM g""",
)
def m2_replay_format(t: Tables):
    """The shipped replay format: robot, wrench and length tables, joined again after reading."""
    path = session.scratch_path(t.spark, "formats")
    formats.shipped().write(
        "replay_tables", _format_timeline(t), path, FORMAT_COLUMNS | {"robot": {"stiffness": 25.0}}
    )
    robot, wrench, lengths = (
        EpisodeTable(t.spark, f"{path}/{n}", ["user_id"]).read().drop("episode_index")
        for n in ("robot", "wrench", "lengths")
    )
    both = robot.join(wrench.drop("t"), ["user_id", "event_id"]).join(lengths, "user_id")
    return both.select(
        "user_id",
        "event_id",
        r6("seconds").alias("seconds"),
        r6(F.get("ts_pose_fb", F.lit(0))).alias("x"),
        r6("gripper").alias("gripper"),
        "stiffness",
        r6(F.get("ts_pose_command", F.lit(0))).alias("command_x"),
        r6(F.get("left_tool", F.lit(0))).alias("fx"),
        r6(F.get("left_tool", F.lit(4))).alias("my"),
        "robot_len",
        "wrench_len",
    )


@query(
    "m2_named_format",
    f"SELECT event_id, {q6('value * 2.5 + 1')} AS y FROM {EV} WHERE event_type = 'view'",
)
def m2_named_format(t: Tables):
    known = formats.Formats()
    known.add(
        formats.Format(
            "scaled",
            lambda df, c: df.select(
                "event_id", r6(F.col("value") * c["map"]["scale"] + c["map"]["offset"]).alias("y")
            ),
            {"map": {"scale": 1.0, "offset": 1.0}},
        )
    )
    return known.build("scaled", t.events("view"), {"map": {"scale": 2.5}})
