"""Streams must give what the same step gives on a table, also for late deliveries."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from braidline.operators import filters, model, statistics
from braidline.queries import live as queries
from braidline.queries import load
from braidline.queries.base import REGISTRY
from braidline.streaming import live, stateful

load()
KEYS = ["user_id"]


def both(tables, rows, step, columns, label):
    table = stateful.walk_table(rows, KEYS, ["t", "seq"], step, columns)
    stream = queries.run(tables, rows, step, columns, label)
    return sorted(map(repr, table.collect())), sorted(map(repr, stream.collect()))


def test_recorded_rows_stream_equals_table(tables):
    a, b = both(tables, queries.frames(tables), live.recorded_rows, live.RECORD_COLUMNS, "rec")
    assert a == b and len(a) > 100


def test_calibration_stream_equals_table(tables):
    step = live.startup_calibration(queries.CALIBRATION, queries.linear_model)
    a, b = both(tables, queries.sensor_rows(tables), step, live.CALIBRATION_COLUMNS, "cal")
    assert a == b
    assert any("ready" in x for x in a)


def test_keys_that_share_a_state_stay_apart(tables, monkeypatch):
    monkeypatch.setattr(stateful, "GROUPS", 2)
    a, b = both(tables, queries.frames(tables), live.recorded_rows, live.RECORD_COLUMNS, "rec")
    assert a == b and len(a) > 100


class Store:
    """One value and one list of a state store, counting the calls."""

    def __init__(self):
        self.value, self.rows, self.calls, self.timers = None, [], 0, []

    def getValueState(self, *_):
        return self

    getListState = getValueState

    def get(self):
        self.calls += 1
        return self.value if self.value is not None else None

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def appendList(self, rows):
        self.calls, self.rows = self.calls + 1, self.rows + rows

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.append(ms)


def test_calls_to_the_state_store_do_not_grow_with_keys():
    """Rows of 500 keys wait, then are stepped, at a few calls for all of them."""
    store, made = Store(), []
    held = Store()
    store.getListState = lambda *_: held
    held.get = lambda: iter(held.rows)
    held.clear = lambda: held.rows.clear()

    def counted(state, row):
        return (state or 0) + 1, [dict(n=(state or 0) + 1)]

    class At:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    walker = stateful._Ordered(["k"], "t", "seq", counted, ["k", "n"])
    walker.init(store)

    class In(dict):
        def asDict(self, recursive=True):
            return dict(self)

    rows = [In(k=i % 500, t=(5 - i // 500) * 10**9, seq=i) for i in range(1500)]
    made += walker.handleInputRows(None, iter(rows), At(0))
    assert not made and len(held.rows) == 1500
    waiting, held.rows = held.rows, []
    held.rows = list(waiting)
    held.get = lambda: iter(list(waiting))
    made += walker.handleExpiredTimer(None, At(10_000), None)
    assert sorted((r["k"], r["n"]) for r in made) == [(k, n) for k in range(500) for n in (1, 2, 3)]
    assert store.calls + held.calls < 12


def walk(step, rows):
    state, out = None, []
    for row in rows:
        state, found = step(state, row)
        out += found
    return out


def frame(t, episode=0, **kw):
    base = dict(
        t=t, seq=t, kind="frame", episode_index=episode, recording=True, gate_ok=True,
        pos=[float(t)], pos_reason=None, gripper_state=1.0,
    )
    return {**base, **kw}


def test_steps_wait_for_the_next_frame_and_stay_inside_episodes():
    out = walk(
        live.completed_steps,
        [frame(1, gate_ok=False), frame(2), frame(5), frame(6, 1), frame(9, 1)],
    )
    assert [(o["from_ns"], o["to_ns"], o["action"]) for o in out] == [(2, 5, [3.0]), (6, 9, [3.0])]


def test_unusable_frames_are_reported():
    out = walk(live.completed_steps, [frame(1), frame(2, pos=None, pos_reason="x"), frame(3)])
    assert [o["dropped_reason"] for o in out] == ["x", None]
    assert out[1]["from_ns"] == 1


def test_recorder_writes_a_terminal_row_and_discards():
    rows = [frame(0, kind="start"), frame(1), frame(2), frame(2, seq=3), frame(9, kind="stop"), frame(10)]
    out = walk(live.recorded_rows, rows)
    assert [(o["source_ns"], o["row_type"]) for o in out] == [(1, "completed"), (2, "completed")]
    out = walk(live.recorded_rows, [frame(0, kind="start"), frame(1), frame(2), frame(9, kind="stop")])
    assert out[-1]["row_type"] == "terminal" and out[-1]["action"] == [0.0]
    out = walk(live.recorded_rows, [frame(0, kind="start"), frame(1), frame(2), frame(9, kind="discard")])
    assert out[-1]["row_type"] == "discarded"


def test_a_recording_after_a_discard_is_kept():
    rows = [
        frame(0, kind="start"), frame(1), frame(2), frame(3, kind="discard"), frame(3, recording=False),
        frame(4, kind="start"), frame(5), frame(6), frame(7, kind="stop"), frame(7, recording=False),
        frame(8, kind="start"), frame(9), frame(10), frame(11, kind="stop"), frame(12, kind="discard"),
    ]
    out = walk(live.recorded_rows, rows)
    gone = {o["recording"] for o in out if o["row_type"] == "discarded"}
    kept = [(o["recording"], o["source_ns"], o["row_type"]) for o in out if o["recording"] not in gone]
    assert gone == {1, 3} and kept == [(2, 5, "completed"), (2, 6, "terminal")]


def calibrate(raw_at, seconds=30):
    step = live.startup_calibration(live.CalibrationSettings(), lambda x: np.hstack([x, x]))
    rows = [
        dict(t=int(i * 1e7), seq=i, kind="sample", raw=raw_at(i / 100)) for i in range(seconds * 100)
    ]
    return walk(step, rows)


def test_calibration_reaches_ready_with_two_tares():
    out = calibrate(lambda s: [100.0, 200.0, 300.0])
    order = list(dict.fromkeys(o["status"] for o in out))
    assert order == [
        "warming_up", "delayed", "provisional_tare", "runtime_settling", "final_tare",
        "bias_calibration", "zero_check", "ready",
    ]
    assert out[-1]["zero_force"] == pytest.approx(0.0)


def test_drift_stays_delayed_and_load_fails_the_zero_check():
    assert calibrate(lambda s: [s * 50.0] * 3)[-1]["status"] == "delayed"
    out = calibrate(lambda s: [0.0 if s < 12.6 else 5.0] * 3)
    assert out[-1]["status"] == "zero_check_failed"


def test_append_stops_at_a_gap():
    rows = [dict(seq=i, frame=f, violation=None) for i, f in enumerate([5, 6, 6, 5, 7, 9, 10])]
    out = [o["verdict"] for o in walk(live.exactly_once_append, rows)]
    assert out == ["appended", "appended", "discarded", "discarded", "appended", "gap", "after_error"]


def test_ring_buffer_is_bounded_by_age_and_count():
    rows = [dict(t=i, seq=i, kind="sample") for i in range(10)] + [dict(t=10, seq=10, kind="start")]
    assert [o["sample_seq"] for o in walk(live.ring_buffer(100, 3, 100), rows)] == [7, 8, 9]
    assert [o["sample_seq"] for o in walk(live.ring_buffer(4, 0, 100), rows)] == [5, 6, 7, 8, 9]
    assert [o["sample_seq"] for o in walk(live.ring_buffer(100, 0, 2), rows)] == [8, 9]


def test_gate_reasons():
    step = live.freshness_gate({"phone": 10, "force": 5}, 3, ("phone", "force"))
    rows = [
        dict(t=0, seq=0, kind="phone", ok=True, error=None),
        dict(t=1, seq=1, kind="check", ok=None, error=None),
        dict(t=4, seq=2, kind="force", ok=False, error="x"),
        dict(t=10, seq=3, kind="check", ok=None, error=None),
    ]
    out = walk(step, rows)
    assert out[0]["reasons"] == "force_missing"
    assert out[1]["reasons"] == "force_stale,force_not_ready,force_error,clock_skew"


@pytest.mark.parametrize("limit", [None, 60])
def test_jump_filter_matches_a_plain_walk(spark, limit):
    rng = np.random.default_rng(0)
    second = 1000
    rows = []
    for key in (1, 2):
        t, p = 0, 50.0
        for i in range(400):
            t += int(rng.choice([10, 60, 120, 400], p=[0.5, 0.3, 0.15, 0.05]))
            p = float(np.clip(p + rng.normal(0, 25), 0, 100)) if rng.random() < 0.8 else float(rng.uniform(0, 100))
            rows.append((key, i, t, p))
    df = spark.createDataFrame(rows, "k long, seq long, t long, percent double")
    out = filters.reject_jumps(df, ["k"], "t", "percent", "seq", second, limit)
    got = {(r["k"], r["seq"]) for r in out.collect()}
    want, last = set(), {}
    for k, i, t, p in rows:
        seen = last.get(k)
        if seen is not None:
            age = (t - seen[0]) / second
            if age <= 0.22 and abs(p - seen[1]) > min(100.0, 28.0 + age * 520.0):
                continue
        last[k] = (t, p)
        want.add((k, i))
    assert got == want and len(want) < len(rows)


def test_one_unbroken_island_is_cut_and_composed(spark):
    """Jumps all the time, no sample agrees with all before it: pieces must know their entries."""
    rng = np.random.default_rng(4)
    rows, t = [], 0
    for i in range(3000):
        t += int(rng.integers(5, 40))
        p = float(rng.choice([5.0, 95.0]) + rng.normal(0, 3))
        rows.append((i, t, None if i % 97 == 0 else p))
    df = spark.createDataFrame(rows, "seq long, t long, percent double").withColumn("k", F.lit(1))
    got = {}
    for limit in (None, 100):
        out = filters.reject_jumps(df, ["k"], "t", "percent", "seq", 1000, limit)
        got[limit] = sorted(r["seq"] for r in out.collect())
    want, last = [], None
    for i, t, p in rows:
        if last is not None:
            age = (t - last[0]) / 1000
            near = p is not None and last[1] is not None and abs(p - last[1]) <= 28.0 + age * 520.0
            if age <= 0.22 and not near:
                continue
        last = (t, p)
        want.append(i)
    assert got[None] == want and got[100] == want and len(want) < 2500


def test_quadratic_fit_matches_numpy_for_every_key(spark, tables):
    rows = tables.vectors().select(
        (F.col("label") % 3).alias("k"), F.slice("e", 1, 12).alias("c"), F.slice("e", 13, 6).alias("w")
    )
    odd = spark.createDataFrame(
        [(0, [None] * 12, [1.0] * 6), (1, None, [1.0] * 6), (2, [1.0] * 12, None), (None, [1.0] * 12, [2.0] * 6)],
        "k int, c array<double>, w array<double>",
    )
    fits = statistics.quadratic_fit(rows.union(odd).repartition(5), ["k"], "c", "w").collect()
    assert {f["k"] for f in fits} == {0, 1, 2, None}
    pdf = rows.toPandas()
    for f in fits:
        if f["k"] is None:
            assert f["rows_used"] == 1
            continue
        own = pdf[pdf["k"] == f["k"]]
        x, y = np.stack(own["c"]), np.stack(own["w"])
        full = np.hstack([x, x**2])
        best, *_ = np.linalg.lstsq(full, y, rcond=None)
        found = np.array(f["coefficients"])
        assert f["rows_used"] == len(own)
        assert np.square(y - full @ found).sum() == pytest.approx(np.square(y - full @ best).sum(), rel=1e-9)


def test_force_model_matches_numpy(tables):
    m = model.seeded_model(3)
    rows = tables.vectors().select("vec_id", F.lit("left").alias("side"), F.slice("e", 1, 12).alias("c"))
    got = model.predict_wrench(rows, "side", "c", {"left": m}).toPandas().sort_values("vec_id")
    x = np.stack(got["c"])
    h = x.astype("float32")
    for i, (w, b) in enumerate(zip(m.weights, m.biases)):
        h = h @ w + b
        h = np.maximum(h, 0) if i < len(m.weights) - 1 else h
    assert np.stack(got["wrench"]) == pytest.approx(h * 2.0, abs=1e-5)


def test_live_clock_mapping_becomes_aligned(tables):
    out = REGISTRY["t11_live_clock_mapping"].build(tables)
    by = {r["alignment_method"]: r["n"] for r in out.groupBy("alignment_method").agg(F.count("*").alias("n")).collect()}
    assert sum(by.values()) == out.select("seq").distinct().count()
