"""Clock fits recover known clocks; guards of the episode segmentation."""

import random

import pytest
from pyspark.sql import functions as F

from braidline.operators import clocks, episodes
from braidline.plans import alignment
from braidline import asof


def test_two_way_fit_recovers_the_clock(spark):
    rng = random.Random(1)
    rows = []
    for i in range(100):
        phone = 1_000_000_000 + i * 100_000_000
        rows.append((1, i, phone, round(0.99995 * phone + 2e12), rng.randint(200_000, 2_200_000)))
    df = spark.createDataFrame(rows, "s long, seq long, phone long, host long, rtt long")
    m = clocks.two_way_fit(df, ["s"], "phone", "host", "rtt", "seq").first()
    assert m["scale"] == pytest.approx(0.99995, abs=1e-8)
    assert m["offset_ns"] == pytest.approx(2e12, abs=1000)
    assert m["method"] == "bidirectional_affine_low_rtt"
    assert m["selected_sample_count"] == 20


def envelope_rows(n=400, step=5_000_000, jitter=900_000, scale=1.000075):
    """Delays repeat every ten rows, so they do not tilt the line."""
    return [
        (1, i, i * step, round(5e11 + scale * i * step) + (i * 7 % 10) * jitter // 9)
        for i in range(n)
    ]


def test_lower_envelope_recovers_the_clock(spark):
    df = spark.createDataFrame(envelope_rows(), "s long, seq long, x long, y long")
    m = clocks.lower_envelope_fit(df, ["s"], "x", "y").first()
    assert m["scale"] == pytest.approx(1.000075, abs=5e-6)
    assert m["offset_ns"] == pytest.approx(5e11, abs=100_000)


def test_envelope_needs_pairs_span_and_no_reset(spark):
    few = spark.createDataFrame(envelope_rows(7), "s long, seq long, x long, y long")
    assert clocks.lower_envelope_fit(few, ["s"], "x", "y").count() == 0
    short = spark.createDataFrame(envelope_rows(20, step=1000), "s long, seq long, x long, y long")
    assert clocks.lower_envelope_fit(short, ["s"], "x", "y").count() == 0
    reset = spark.createDataFrame(envelope_rows(), "s long, seq long, x long, y long").withColumn(
        "r", F.col("seq") == 50
    )
    assert clocks.lower_envelope_fit(reset, ["s"], "x", "y", "r").count() == 0


def test_counter_unwraps_and_flags_resets(spark):
    raw = [4294967000, 100, 300, 200, None, 250]
    df = spark.createDataFrame(list(enumerate(raw)), "seq long, c long").withColumn("s", F.lit(1))
    for limit in (None, 2):
        out = clocks.unwrap_counter(df, ["s"], ["seq"], "c", limit).orderBy("seq").collect()
        assert [r["unwrapped"] for r in out] == [
            4294967000, 4294967396, 4294967596, 4294967496, None, 4294967546,
        ]
        assert [r["clock_reset"] for r in out] == [False, False, False, True, False, False]


def test_device_packets_align_to_ideal_times(spark):
    rng = random.Random(4)
    rows = [(1, i, i * 5_000_000, 10**12 + i * 5_000_000 + rng.randint(0, 300_000)) for i in range(20)]
    df = spark.createDataFrame(rows, "s long, seq long, x long, y long").withColumn("r", F.lit(False))
    model = clocks.lower_envelope_fit(df, ["s"], "x", "y")
    out = clocks.apply_envelope(df, model, ["s"], "x", "y", "r").where("seq = 7").first()
    assert out["aligned_ns"] == pytest.approx(10**12 + 7 * 5_000_000, abs=100_000)
    assert out["y"] == rows[7][3]


SECOND = 1_000_000_000


def pair(spark, events, **kw):
    df = spark.createDataFrame(
        [(s, k, t, i) for i, (s, k, t) in enumerate(events)], "s string, k string, t long, i long"
    )
    good, bad = episodes.pair_start_stop(df, "s", "k", "t", "i", **kw)
    return [tuple(r) for r in good.orderBy("episode_index").collect()], {
        r["s"]: r["reason"] for r in bad.collect()
    }


def start(s, t):
    return (s, "record_start", int(t * SECOND))


def stop(s, t):
    return (s, "record_stop", int(t * SECOND))


def test_pairs_are_indexed_by_start(spark):
    good, bad = pair(spark, [start("b", 10), stop("b", 20), start("a", 1), stop("a", 5)])
    assert good == [(0, "a", SECOND, 5 * SECOND), (1, "b", 10 * SECOND, 20 * SECOND)]
    assert bad == {}


@pytest.mark.parametrize(
    "events, reason",
    [
        ([start("a", 1)], "unmatched_events"),
        ([start("a", 1), stop("b", 5)], "unmatched_events"),
        ([start("a", 1), stop("a", 701)], "invalid_duration"),
        ([start("a", 5), stop("a", 5)], "invalid_duration"),
        ([start("a", 1), stop("a", 20), start("a", 10), stop("a", 30)], "overlap"),
    ],
)
def test_refused_sessions(spark, events, reason):
    good, bad = pair(spark, events)
    assert good == [] and bad["a"] == reason


def test_duration_tolerance(spark):
    good, bad = pair(spark, [start("a", 0), stop("a", 600.5)])
    assert len(good) == 1 and not bad


def windows(spark, events):
    df = spark.createDataFrame(
        [(s, k, t, i) for i, (s, k, t) in enumerate(events)], "s string, k string, t long, i long"
    )
    good, bad = episodes.closed_windows(df, "s", "k", ["i"], "t")
    return sorted((r["s"], r["start_ns"], r["end_ns"]) for r in good.collect()), {
        r["s"] for r in bad.collect()
    }


def test_two_windows_in_one_session_and_an_open_one_beside(spark):
    events = [
        ("a", "record_start", 100), ("a", "record_stop", 200), ("a", "record_start", 300),
        ("a", "record_stop", 400), ("b", "record_start", 100),
    ]
    good, bad = windows(spark, events)
    assert good == [("a", 100, 200), ("a", 300, 400)]
    assert bad == {"b"}


def test_nested_start_refuses_the_session_and_stray_stops_are_ignored(spark):
    good, bad = windows(
        spark,
        [
            ("a", "record_stop", 50), ("a", "record_start", 100), ("a", "record_stop", 200),
            ("b", "record_start", 1), ("b", "record_start", 2), ("b", "record_stop", 3),
        ],
    )
    assert good == [("a", 100, 200)] and bad == {"b"}


def test_bracket_interpolation_and_gap_limit(spark):
    ms = 1_000_000
    t = spark.createDataFrame([(1, 0, 15 * ms)], "k long, id long, t long")
    c = spark.createDataFrame([(1, 0, 16 * ms)], "k long, id long, t long")
    f = spark.createDataFrame(
        [(1, 0, 10 * ms, [0.0], [1.0]), (1, 1, 20 * ms, [10.0], [3.0])],
        "k long, id long, t long, left_wrench array<double>, right_wrench array<double>",
    )

    def run(limit):
        out = alignment.align(
            t, asof.Stream(c, "t", "id"), asof.Stream(f, "t", "id"), ["k"], "t", "id",
            force_max_ms=limit,
        )
        return out.first()

    ok = run(25)["force"]
    assert ok["valid"] and ok["alpha"] == 0.5
    assert ok["left_wrench"] == [5.0] and ok["right_wrench"] == [2.0]
    assert ok["row"]["id"] == 0  # equal distance: the earlier row
    wide = run(5)["force"]
    assert not wide["valid"] and wide["dropped_reason"] == "bracketing_gap_outside_threshold"


def test_uniform_timeline_excludes_the_end(spark):
    ep = spark.createDataFrame([(1, 0, SECOND)], "e long, s long, x long")
    ticks = [r["t"] for r in alignment.uniform_targets(ep, ["e"], "s", "x", 4).orderBy("t").collect()]
    assert ticks == [0, 250_000_000, 500_000_000, 750_000_000]
    assert alignment.uniform_targets(ep, ["e"], "s", "x", 0).count() == 0


def test_ends_count_changes_not_ids(spark):
    df = spark.createDataFrame(list(enumerate([0, 0, 1, 0, 70000])), "i long, e long")
    df = episodes.clamp_episode_id(df, "e")
    for limit in (None, 2):
        ends = [r["episode_end"] for r in episodes.ends_at_changes(df, ["i"], "e", limit).collect()]
        assert sorted(ends) == [2, 3, 5]
    assert sorted(r["episode_end"] for r in episodes.ends_by_id(df, "e").collect()) == [4, 5]


def test_bounds_settle_most_forward_windows(spark):
    """A pose that swings and then rests: the rest is found, few windows are compared row by row."""
    rng = random.Random(3)
    rows = []
    for k in range(3000):
        swing = 5.0 if k < 2000 else 0.4
        rows.append((1, k * 10, *[rng.uniform(-swing, swing) for _ in range(3)], rng.uniform(-1, 1)))
    rows.append((2, 0, 1.0, None, 1.0, 0.0))
    rows += [(2, 10 * k, 1.0, 1.0, 1.0, 0.0) for k in range(1, 40)]
    df = spark.createDataFrame(rows, "k long, t long, x double, y double, z double, turn double")
    starts = spark.createDataFrame([(1, 0), (2, 0)], "k long, effective_start long")
    limits = [(["x", "y", "z"], 0.75), (["turn"], 2.0)]

    def still(at, own):
        inside = [r[2:] for r in own if at <= r[1] <= at + 500]
        if len(inside) < 2 or any(v is None for r in inside for v in r):
            return False
        far = []
        for cols in ((0, 1, 2), (3,)):
            mean = [sum(r[c] for r in inside) / len(inside) for c in cols]
            far.append(max(sum((r[c] - m) ** 2 for c, m in zip(cols, mean)) ** 0.5 for r in inside))
        return far[0] < 0.75 and far[1] < 2.0

    judged = episodes.judged_windows(df, starts, ["k"], "t", limits, 500, 0)
    plain = {(k, r[1]): still(r[1], [x for x in rows if x[0] == k]) for k in (1, 2) for r in rows if r[0] == k}
    found = {(r["k"], r["t"]): r["_still"] for r in judged.collect()}
    assert set(found) == set(plain)
    assert all(v is None or v == plain[k] for k, v in found.items())
    sure = judged.where("_still").groupBy("k").agg(F.min("t").alias("_sure"))
    assert episodes.open_windows(judged, sure, ["k"], "t").count() <= 60
    out = episodes.effective_end(df, starts, ["k"], "t", ["x", "y", "z"], ["turn"], 500, 0, 0.75, 2.0)
    ends = {r["k"]: r["effective_end"] for r in out.collect()}
    assert ends == {k: min(t for (q, t), ok in plain.items() if ok and q == k) for k in (1, 2)}


def test_two_way_fit_of_cut_sessions_is_the_same(spark):
    rng = random.Random(8)
    rows = [
        (k, i, i * 10**8, 5 * 10**12 + i * 100_001_000 + rng.randint(0, 900), rng.randint(1, 60) * 1000)
        for k, n in ((1, 500), (2, 9), (3, 2)) for i in range(n)
    ]
    df = spark.createDataFrame(rows, "k int, seq long, phone long, host long, rtt long")
    fits = [
        sorted(clocks.two_way_fit(df, ["k"], "phone", "host", "rtt", "seq", limit).collect())
        for limit in (None, 40)
    ]
    assert [f["k"] for f in fits[0]] == [1, 2, 3]
    for plain, cut in zip(*fits):
        for name in plain.asDict():
            assert cut[name] == (
                pytest.approx(plain[name], rel=1e-9, abs=1e-6) if name != "method" else plain[name]
            )
    assert [f["selected_sample_count"] for f in fits[0]] == [100, 8, 2]
