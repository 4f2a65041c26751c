"""Live operators as step functions, for streams and tables alike."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np

from braidline.operators.statistics import SEQUENCE_GAP_LIMIT, UINT32

# Age limits of the live gate and buffer sizes.
FRESH_S = {"phone": 2.0, "camera": 2.5, "force": 1.0}
LIVE_SKEW_S = 1.5
BUFFER_S, PREROLL_S = 3.0, 1.5

# ---------------------------------------------------------------------------
# Completed steps and recorded rows

STEP_COLUMNS = """from_ns long, to_ns long, dt_ms double, episode_index long, recording boolean,
    row_pos array<double>, action array<double>, gripper_state double, gripper_action double,
    dropped_reason string"""


def completed_steps(state, row):
    """A step is complete when the next usable frame of its episode arrives.

    Rows need t, episode_index, recording, gate_ok, pos (array or null),
    pos_reason, gripper_state (or null). Unusable frames are reported with their
    reason and do not end the step before them.
    """
    empty = dict(
        from_ns=None, to_ns=row["t"], dt_ms=None, episode_index=row["episode_index"],
        recording=bool(row["recording"]), row_pos=None, action=None, gripper_state=None,
        gripper_action=None, dropped_reason=None,
    )
    if not row["gate_ok"]:
        return state, []
    pos = row["pos"]
    if pos is None:
        return state, [{**empty, "dropped_reason": row["pos_reason"] or "pose_invalid"}]
    if row["gripper_state"] is None:
        return state, [{**empty, "dropped_reason": "gripper_invalid"}]
    pos = [float(x) for x in pos]
    now = dict(
        t=row["t"], episode=row["episode_index"], recording=bool(row["recording"]), pos=pos,
        grip=float(row["gripper_state"]),
    )
    found = []
    if state is not None and state["episode"] == now["episode"]:
        found.append(
            dict(
                from_ns=state["t"],
                to_ns=now["t"],
                dt_ms=(now["t"] - state["t"]) / 1e6,
                episode_index=now["episode"],
                recording=state["recording"] and now["recording"],
                row_pos=state["pos"],
                action=[b - a for a, b in zip(state["pos"], pos)],
                gripper_state=state["grip"],
                gripper_action=now["grip"],
                dropped_reason=None,
            )
        )
    return now, found


RECORD_COLUMNS = """recording long, source_ns long, episode_index long, next_ns long, dt_ms double,
    action array<double>, gripper_action double, row_type string"""


def recorded_rows(state, row):
    """Completed recording steps, each source once, and a terminal row at the stop.

    Besides the rows of ``completed_steps``, rows with kind start, stop or
    discard arrive. Recordings are numbered by their starts, as an episode index
    is given again after a discard. A discard concerns the recording under way
    or else the last one, and is emitted as such; leave recordings out with
    ``without_discarded``.
    """
    step, number, under_way, written = state or (None, 0, False, None)
    kind = row["kind"]

    def record(row_type, source=None, episode=None, following=None, dt=None, action=(), grip=None):
        return dict(
            recording=number, source_ns=source, episode_index=episode, next_ns=following, dt_ms=dt,
            action=list(action), gripper_action=grip, row_type=row_type,
        )

    def is_new(source):
        # rows arrive in time order, so the last source written tells
        return written is None or source > written

    if kind == "start":
        return (step, number + 1, True, None), []
    if kind == "discard":
        return (step, number, False, None), [record("discarded")] if number else []
    if kind == "stop":
        tail = under_way and step is not None and step["recording"] and is_new(step["t"])
        zero = [0.0] * len(step["pos"]) if tail else []
        found = [record("terminal", step["t"], step["episode"], None, None, zero, step["grip"])] if tail else []
        return (step, number, False, written), found
    step, done = completed_steps(step, row)
    found = []
    for d in done:
        if d["dropped_reason"] is None and d["recording"] and under_way and is_new(d["from_ns"]):
            written = d["from_ns"]
            found.append(
                record(
                    "completed", d["from_ns"], d["episode_index"], d["to_ns"], d["dt_ms"], d["action"],
                    d["gripper_action"],
                )
            )
    return (step, number, under_way, written), found


def without_discarded(records, keys: list[str]):
    """Recorded rows of the recordings that were not discarded."""
    from pyspark.sql import functions as F

    by = [*keys, "recording"]
    gone = records.where(F.col("row_type") == "discarded").select(*by).distinct()
    return records.join(gone, by, "left_anti")


# ---------------------------------------------------------------------------
# Ring buffer

RING_COLUMNS = "event_seq long, sample_seq long, sample_ns long"


def ring_buffer(max_age_ns: int, max_items: int, preroll_ns: int):
    """Keep recent samples; a start event emits those of its pre-roll."""

    def step(state, row):
        kept = state or []
        if row["kind"] == "start":
            low = row["t"] - preroll_ns
            return kept, [
                dict(event_seq=row["seq"], sample_seq=s, sample_ns=at)
                for at, s in kept
                if at >= low
            ]
        kept = [x for x in kept if x[0] >= row["t"] - max_age_ns] + [(row["t"], row["seq"])]
        return kept[-max_items:] if max_items else kept, []

    return step


# ---------------------------------------------------------------------------
# T4: freshness gate

GATE_COLUMNS = "t long, seq long, ready boolean, reasons string"


def freshness_gate(limits_ns: dict[str, int], skew_ns: int, skewed: tuple[str, str]):
    """State of all streams at every check row. (T4)

    Rows have kind (a stream's name, or "check"), ok and error (text or null).
    Calibration and other conditions arrive as ok and error of their stream.
    """

    def step(state, row):
        seen = dict(state or {})
        if row["kind"] != "check":
            seen[row["kind"]] = (row["t"], bool(row["ok"]), row["error"])
            return seen, []
        reasons = []
        for name, limit in limits_ns.items():
            if name not in seen:
                reasons.append(f"{name}_missing")
                continue
            at, ok, error = seen[name]
            if row["t"] - at > limit:
                reasons.append(f"{name}_stale")
            if not ok:
                reasons.append(f"{name}_not_ready")
            if error:
                reasons.append(f"{name}_error")
        a, b = skewed
        if a in seen and b in seen and abs(seen[a][0] - seen[b][0]) > skew_ns:
            reasons.append("clock_skew")
        return seen, [
            dict(t=row["t"], seq=row["seq"], ready=not reasons, reasons=",".join(reasons))
        ]

    return step


# ---------------------------------------------------------------------------
# T5: start-up calibration


@dataclass(frozen=True)
class CalibrationSettings:
    """Durations in seconds and limits of the start-up calibration."""

    window_s: float = 2.0
    min_wait_s: float = 5.0
    interval_s: float = 0.5
    mean_delta: float = 8.0
    noise_std: float = 20.0
    passes: int = 3
    settle_s: float = 5.0
    tare_s: float = 2.0
    bias_s: float = 1.0
    check_s: float = 1.0
    zero_limit_n: float = 0.15
    second_ns: int = 1_000_000_000


CALIBRATION_COLUMNS = "t long, seq long, status string, ready boolean, zero_force double, fx double"


# Fixed value: share of a window that its rows must span.
COVERAGE = 0.7


class RunningSums:
    """Count, sum and sum of squares up to each recent row; windows are differences of two rows."""

    def __init__(self, horizon: float):
        self.horizon, self.base = horizon, None
        self.times, self.sums = [-np.inf], []

    def add(self, at: float, values: np.ndarray) -> None:
        if self.base is None:  # sums relative to the first row stay small
            self.base = values
            self.sums.append((0, np.zeros_like(values), np.zeros_like(values)))
        n, total, squares = self.sums[-1]
        off = values - self.base
        self.times.append(at)
        self.sums.append((n + 1, total + off, squares + off * off))
        # the row before the oldest window stays as what to subtract
        old = max(bisect_left(self.times, at - self.horizon) - 1, 0)
        del self.times[:old], self.sums[:old]

    def window(self, low: float, high: float) -> tuple[np.ndarray, np.ndarray] | None:
        """Mean and deviation over [low, high]; None if its rows do not span enough of it."""
        i, j = bisect_left(self.times, low, 1), bisect_right(self.times, high)
        if j - i < 2 or self.times[j - 1] - self.times[i] < COVERAGE * (high - low):
            return None
        n, total, squares = (b - a for a, b in zip(self.sums[i - 1], self.sums[j - 1]))
        mean = total / n
        return mean + self.base, np.sqrt(np.maximum(squares / n - mean * mean, 0.0))


@dataclass
class _Stability:
    """First stage: is the sensor quiet? Counts passed checks in a row."""

    cfg: CalibrationSettings
    sums: RunningSums
    first: float
    last_check: float | None = None
    passed: int = 0
    done: bool = False

    def status(self, at: float) -> str:
        cfg = self.cfg
        waiting = self.last_check is None and at - self.first < cfg.min_wait_s
        due = self.last_check is None or at - self.last_check >= cfg.interval_s
        if waiting:
            return "warming_up"
        if due:
            self.last_check = at
            self.passed = self.passed + 1 if self._quiet(at) else 0
            self.done = self.passed >= max(1, cfg.passes)
        return "provisional_tare" if self.done else "delayed"

    def _quiet(self, at: float) -> bool:
        w = self.cfg.window_s
        both = self.sums.window(at - 2 * w, at - w), self.sums.window(at - w, at)
        if None in (both[0], both[1]):
            return False
        (before, _), (now, deviation) = both
        moved = np.abs(now - before).max()
        return moved <= self.cfg.mean_delta and np.median(deviation) <= self.cfg.noise_std


@dataclass
class _Average:
    """A stage that averages wrenches from its first row until it has lasted long enough."""

    duration: float
    start: float | None = None
    n: int = 0
    total: np.ndarray | float = 0.0

    def mean(self, at: float, wrench: np.ndarray) -> np.ndarray | None:
        if self.start is None:
            self.start = at
        self.n, self.total = self.n + 1, self.total + wrench
        return self.total / self.n if at - self.start >= self.duration else None


class _Calibration:
    """The stages of one sensor set; each hands the next one a number it found."""

    def __init__(self, cfg: CalibrationSettings, at: float):
        self.cfg = cfg
        self.sums = RunningSums(max(2 * cfg.window_s, cfg.tare_s))
        self.stability = _Stability(cfg, self.sums, at)
        self.settling = self.offset = self.bias = self.zero = None
        self.averages = _Average(cfg.bias_s), _Average(cfg.check_s)

    def memory(self) -> dict:
        """Plain values that a state store can keep."""
        quiet = {k: v for k, v in vars(self.stability).items() if k not in ("cfg", "sums")}
        return dict(
            sums=self.sums and vars(self.sums), quiet=quiet, averages=[vars(a) for a in self.averages],
            found=(self.settling, self.offset, self.bias, self.zero),
        )

    @classmethod
    def restored(cls, cfg: CalibrationSettings, memory: dict) -> _Calibration:
        out = cls(cfg, memory["quiet"]["first"])
        vars(out.stability).update(memory["quiet"])
        if memory["sums"]:
            vars(out.sums).update(memory["sums"])
        for average, held in zip(out.averages, memory["averages"]):
            vars(average).update(held)
        out.settling, out.offset, out.bias, out.zero = memory["found"]
        return out

    def status(self, at: float, raw: np.ndarray, model) -> str:
        if self.offset is None:
            self.sums.add(at, raw)
            if not self.stability.done:
                return self.stability.status(at)
            return self._settle(at)
        wrench = self.wrench(raw, model)
        if self.bias is None:
            self.bias = self.averages[0].mean(at, wrench)
            if self.bias is None:
                return "bias_calibration"
            self.averages[1].start = at
            return "zero_check"
        if self.zero is None:
            mean = self.averages[1].mean(at, wrench - self.bias)
            if mean is None:
                return "zero_check"
            self.zero = float(np.abs(mean[:3]).max())
        return "ready" if self.zero <= self.cfg.zero_limit_n else "zero_check_failed"

    def _settle(self, at: float) -> str:
        self.settling = at if self.settling is None else self.settling
        recent = self.sums.window(at - self.cfg.tare_s, at)
        if at - self.settling < self.cfg.settle_s or recent is None:
            return "runtime_settling"
        self.offset, self.sums = recent[0], None
        return "final_tare"

    def wrench(self, raw: np.ndarray, model) -> np.ndarray:
        return np.asarray(model((raw - self.offset)[None, :]))[0]


def startup_calibration(settings: CalibrationSettings, model):
    """Warm-up, stability, two tares, bias and zero check of a sensor set. (T5)

    Rows have t, seq and raw (channels of all sides). ``model`` maps tared
    channels to wrenches (n x axes, forces first); its first three axes are
    checked. A row of kind "restart" begins anew. The state holds running sums
    over two windows until the tare, and two vectors afterwards.
    """

    def step(state, row):
        if row["kind"] == "restart":
            return None, []
        at, raw = row["t"] / settings.second_ns, np.array(row["raw"], dtype=float)
        now = _Calibration.restored(settings, state) if state else _Calibration(settings, at)
        status = now.status(at, raw, model)
        ready = status == "ready"
        fx = float((now.wrench(raw, model) - now.bias)[0]) if ready else None
        return now.memory(), [
            dict(t=row["t"], seq=row["seq"], status=status, ready=ready, zero_force=now.zero, fx=fx)
        ]

    return step


# ---------------------------------------------------------------------------
# gaps

APPEND_COLUMNS = "seq long, frame long, verdict string, expected long"


def exactly_once_append(state, row):
    """Frames in sequence are appended once; repeats are discarded, a gap is an error.

    Rows have frame, its number in the session, and violation (text or null).
    After a gap or a broken frame the archive stops.
    """
    expected, broken = state or (row["frame"], False)
    frame = row["frame"]
    if broken:
        verdict = "after_error"
    elif frame < expected:
        verdict = "discarded"
    elif frame > expected:
        verdict, broken = "gap", True
    elif row["violation"] is not None:
        verdict, broken = row["violation"], True
    else:
        verdict = "appended"
    out = dict(seq=row["seq"], frame=frame, verdict=verdict, expected=expected)
    return (expected + (verdict == "appended"), broken), [out]


MONITOR_COLUMNS = "seq long, dropped long, discarded boolean, rate_hz double"


def sequence_monitor(state, row):
    """Live packet monitor: gaps count as drops; a packet out of order is discarded, counts one
    drop, becomes the reference and restarts the rate window. (T7)

    Rows have sequence (uint32) and device_us.
    """
    seq, us = row["sequence"], row["device_us"]
    last, first_us, count = state or (None, us, 0)
    gap = 0 if last is None else (seq - last - 1) % UINT32
    if last is not None and gap >= SEQUENCE_GAP_LIMIT:
        out = dict(seq=row["seq"], dropped=1, discarded=True, rate_hz=None)
        return (seq, us, 0), [out]
    count += 1
    span = us - first_us
    rate = (count - 1) / (span / 1e6) if span > 0 and count > 1 else None
    return (seq, first_us, count), [
        dict(seq=row["seq"], dropped=int(gap), discarded=False, rate_hz=rate)
    ]


# ---------------------------------------------------------------------------
# Recording transitions

# Phase of the recording after each event; others keep the phase.
PHASES = {
    "record_start_requested": "starting",
    "record_start_committed": "active",
    "record_start_postcheck_ok": "active",
    "record_stop_requested": "stopping",
    "record_stop_committed": "stopped",
    "record_discard_requested": "discarding",
    "record_discard_committed": "discarded",
    "record_start_rejected": "error",
    "record_start_failed": "error",
    "record_start_postcheck_failed": "error",
}
TRANSITION_COLUMNS = "event_seq long, transition_seq long, event string, phase string"


def recording_transitions(state, row):
    """Number the recording events of a run and follow the phase."""
    number, phase = state or (0, "idle")
    number, phase = number + 1, PHASES.get(row["event"], phase)
    return (number, phase), [
        dict(event_seq=row["seq"], transition_seq=number, event=row["event"], phase=phase)
    ]


