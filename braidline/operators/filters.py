"""Predicates on aligned rows, exclusions, and the tracker's outlier filter."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import ordered, session
from braidline.functions import se3

# Gates of the marker tracker.
JUMP_GUARD_S = 0.22
JUMP_BASE_PERCENT = 28.0
JUMP_PERCENT_PER_S = 520.0
LEFT_MAX_FRAME_X = 2.0 / 3.0
RIGHT_MIN_FRAME_X = 0.5
MIN_TRAVEL_PX = 60.0
PATH_LIMITS = {0: (20.0, 0.16), 1: (32.0, 0.24)}


def in_window(time: Column, start: Column | None, end: Column | None) -> Column:
    """Inclusive window; a missing bound does not limit. (F1)"""
    out = F.lit(True)
    if start is not None:
        out = out & F.coalesce(time >= start, start.isNull())
    if end is not None:
        out = out & F.coalesce(time <= end, end.isNull())
    return out


def usable_pose(pose: Column) -> Column:
    """Valid, calibrated and in the user's world frame."""
    return F.coalesce(
        pose["valid"] & pose["world_calibrated"] & (pose["frame"] == "user_world"), F.lit(False)
    )


def exportable(stream_valid: Column, rgb: Column, pose: Column) -> Column:
    """Has a decodable image reference and a usable pose. (F2)"""
    return (
        F.coalesce(stream_valid, F.lit(True))
        & F.coalesce(rgb["valid"], F.lit(True))
        & F.coalesce(rgb["codec"] == "h264", F.lit(False))
        & rgb["video_path"].isNotNull()
        & rgb["frame_index"].isNotNull()
        & usable_pose(pose)
    )


def all_streams_valid(*flags: Column) -> Column:
    """Every stream valid; unknown counts as not valid."""
    out = F.lit(True)
    for f in flags:
        out = out & F.coalesce(f, F.lit(False))
    return out


def strictly_exportable(flags: list[Column], pose: Column) -> Column:
    """All streams valid and a usable pose."""
    return all_streams_valid(*flags) & usable_pose(pose)


def finite_six(vector: Column) -> Column:
    """The vector when it holds six finite numbers, else null."""
    inf = float("inf")
    ok = (F.size(vector) == 6) & F.forall(
        vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf)
    )
    return F.when(ok, vector)


def dual_wrench(combined: Column, left: Column, right: Column) -> Column:
    """[left, right] from the combined value when complete, else from the sides."""
    a, b = finite_six(F.get(combined, F.lit(0))), finite_six(F.get(combined, F.lit(1)))
    both = (F.size(combined) == 2) & a.isNotNull() & b.isNotNull()
    left, right = finite_six(left), finite_six(right)
    return F.when(both, F.array(a, b)).when(
        left.isNotNull() & right.isNotNull(), F.array(left, right)
    )


def calibration_accepted(status: Column, has_wrench: Column) -> Column:
    """Status null or ok, and the quality flag not cleared."""
    return (status.isNull() | (status == "ok")) & F.coalesce(has_wrench, F.lit(True))


def without_excluded(timeline: DataFrame, exclusions: DataFrame, session: str) -> DataFrame:
    """Timeline rows whose session is not excluded; rows without a session stay."""
    banned = exclusions.where(F.col(session).isNotNull()).select(session).distinct()
    return timeline.join(banned, session, "left_anti")


def register_exclusions(
    existing: DataFrame, wanted: DataFrame, session: str, source_index: str
) -> DataFrame:
    """Existing exclusions plus the wanted ones not yet there. (F8)

    A request is already there when its session, or else its source index, is.
    Requests with neither are refused.
    """
    valid = wanted.where(F.col(session).isNotNull() | F.col(source_index).isNotNull())
    by_session = existing.where(F.col(session).isNotNull()).select(session).distinct()
    by_index = existing.where(F.col(source_index).isNotNull()).select(source_index).distinct()
    fresh = valid.join(by_session, session, "left_anti").join(by_index, source_index, "left_anti")
    # two requests for one episode count once: first by session, then by index
    for key, other in ((session, source_index), (source_index, session)):
        named = fresh.where(F.col(key).isNotNull())
        rest = [c for c in fresh.columns if c != key]
        one = named.groupBy(key).agg(
            F.min_by(F.struct(*rest), F.struct(F.col(other).isNull(), other)).alias("_r")
        )
        fresh = fresh.where(F.col(key).isNull()).unionByName(one.select(key, "_r.*"))
    return existing.unionByName(fresh.select(*existing.columns))


def effective_rows(rows: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows inside the episode's effective segment."""
    return rows.where(F.col(time).between(F.col(start), F.col(end)))


def marker_region(marker: Column, x: Column, frame_width: Column) -> Column:
    """Left markers stay left of 2/3 of the frame, right ones right of 1/2."""
    return F.when(marker == 0, x <= frame_width * LEFT_MAX_FRAME_X).when(
        marker == 1, x >= frame_width * RIGHT_MIN_FRAME_X
    ).otherwise(F.lit(True))


def path_error_limit(marker: Column, length: Column) -> Column:
    """How far from its path a marker may be seen."""
    out = F.lit(None).cast("double")
    for m, (low, rate) in PATH_LIMITS.items():
        out = F.when(marker == m, F.greatest(F.lit(low), length * rate)).otherwise(out)
    return out


def on_path(
    markers: DataFrame, paths: DataFrame, marker: str, x: str, y: str, frame_width: str
) -> DataFrame:
    """Markers in their region and near their path, with ``percent`` along it.

    ``paths`` has one row per marker: ax, ay, bx, by.
    """
    p = se3.project_on_segment(*[F.col(c) for c in (x, y, "ax", "ay", "bx", "by")])
    m = F.col(marker)
    joined = markers.join(paths, marker, "left").withColumn("_p", p)
    short = F.coalesce(F.col("_p.length") < MIN_TRAVEL_PX, F.lit(True))
    near = F.col("_p.error") <= path_error_limit(m, F.col("_p.length"))
    return (
        joined.where(marker_region(m, F.col(x), F.col(frame_width)) & (short | near))
        .withColumn("percent", F.when(~short, F.col("_p.t") * 100.0))
        .drop("_p", "ax", "ay", "bx", "by")
    )


def _follows(t: float, p: float, last: tuple[float, float], second: int) -> bool:
    """Whether a sample may come after the last accepted one; NaN is far from everything."""
    age = (t - last[0]) / second
    return age > JUMP_GUARD_S or abs(p - last[1]) <= JUMP_BASE_PERCENT + age * JUMP_PERCENT_PER_S


def _numbers(column: pa.Array) -> list[float]:
    return [float("nan") if x is None else x for x in column.to_pylist()]


def _runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """(run, batch, from, upto) of the stretches of equal ``names`` in sorted batches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = list(zip(*[batch.column(n).to_pylist() for n in names]))
        start = 0
        for i in range(1, len(ids) + 1):
            if i == len(ids) or ids[i] != ids[start]:
                yield ids[start], batch, start, i
                start = i


def _accept(
    batches: Iterator[pa.RecordBatch], names: list[str], second: int, entered: bool
) -> Iterator[pa.RecordBatch]:
    """Walk runs in order, holding only the last accepted sample between batches.

    A run starts afresh, or, if ``entered``, from the sample accepted before it.
    Rows are filtered as they came, so no column is converted.
    """
    here, last = None, None
    for run, batch, start, upto in _runs(batches, names):
        part = batch.slice(start, upto - start)
        if run != here:
            here, last = run, None
            if entered and not part.column("_fresh")[0].as_py():
                last = tuple(_numbers(part.column(c).slice(0, 1))[0] for c in ("_entry_t", "_entry_p"))
        keep = []
        for t, p in zip(_numbers(part.column("_t")), _numbers(part.column("_percent"))):
            ok = last is None or _follows(t, p, last, second)
            if ok:
                last = (t, p)
            keep.append(ok)
        yield part.filter(pa.array(keep, pa.bool_()))


class _Piece:
    """What a piece of a track does to the last accepted sample.

    After a sample is accepted, what follows depends on that sample only. So
    the way through the piece from each of its samples is found once, from the
    ways that it runs into, and an entry needs its first accepted sample.
    """

    def __init__(self, second: int):
        self.second = second
        self.before: list[tuple[float, float]] = []
        self.own: list[tuple[float, float]] = []
        self._ends: dict[int, tuple[float, float]] = {}

    def _next(self, last: tuple[float, float], start: int) -> int | None:
        for j in range(start, len(self.own)):
            if _follows(*self.own[j], last, self.second):
                return j
        return None

    def _end(self, i: int) -> tuple[float, float]:
        way = []
        while i not in self._ends:
            way.append(i)
            after = self._next(self.own[i], i + 1)
            if after is None:
                self._ends[i] = self.own[i]
                break
            i = after
        for k in way:
            self._ends[k] = self._ends[i]
        return self._ends[i]

    def rows(self) -> Iterator[tuple]:
        """(fresh, entry, exit): from the first sample, and from each sample just before."""
        yield True, (None, None), self._end(0)
        for entry in dict.fromkeys(self.before):
            first = self._next(entry, 0)
            yield False, entry, entry if first is None else self._end(first)


_WAYS = ["_fresh", "_entry_t", "_entry_p", "_exit_t", "_exit_p"]
_WAYS_SCHEMA = "_fresh boolean, _entry_t long, _entry_p double, _exit_t long, _exit_p double"
_WAYS_KINDS = [pa.bool_(), pa.int64(), pa.float64(), pa.int64(), pa.float64()]


def _plain(sample: tuple) -> tuple:
    """Nulls in place of NaN."""
    return tuple(None if x != x else x for x in sample)


def _batch_of(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _ways(batches: Iterator[pa.RecordBatch], names: list[str], second: int) -> Iterator[pa.RecordBatch]:
    """The entries and exits of every piece; its rows come after those just before it."""
    here, piece, kinds = None, None, []

    def found() -> pa.RecordBatch:
        rows = [(*here, fresh, *_plain(entry), *_plain(exit_)) for fresh, entry, exit_ in piece.rows()]
        return _batch_of(rows, [*kinds, *_WAYS_KINDS], [*names, *_WAYS])

    for run, batch, start, upto in _runs(batches, names):
        if run != here:
            if piece is not None and piece.own:
                yield found()
            here, piece = run, _Piece(second)
            kinds = [batch.column(n).type for n in names]
        part = batch.slice(start, upto - start)
        samples = zip(_numbers(part.column("_t")), _numbers(part.column("_percent")))
        for own, sample in zip(part.column("_own").to_pylist(), samples):
            (piece.own if own else piece.before).append(sample)
    if piece is not None and piece.own:
        yield found()


def _entries(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The sample with which each piece of a key is entered, from the ways through all before it."""
    names = [*keys, ordered.PIECE]
    here, state, ways = None, None, {}
    out: list[tuple] = []
    kinds: list[pa.DataType] = []

    def entered(run: tuple, first: bool) -> tuple:
        """Row of the piece, and the state behind it."""
        if first:
            return (*run, True, None, None), ways[None]
        if state[0] != state[0]:
            return (*run, False, *_plain(state)), state  # nothing follows a sample without a time
        if _plain(state) in ways:
            return (*run, False, *_plain(state)), ways[_plain(state)]
        return (*run, True, None, None), ways[None]  # longer ago than the guard time

    for run, batch, start, upto in _runs(batches, names):
        part = batch.slice(start, upto - start)
        fresh, *states = [part.column(c) for c in _WAYS]
        states = [states[0].to_pylist(), states[1].to_pylist(), *map(_numbers, states[2:])]
        if run != here:
            if here is not None:
                row, state = entered(here, state is None)
                out.append(row)
                if here[:-1] != run[:-1]:
                    state = None
            here, ways = run, {}
            kinds = [batch.column(n).type for n in names]
        for starts, a, b, c, d in zip(fresh.to_pylist(), *states):
            ways[None if starts else (a, b)] = c, d
    if here is not None:
        out.append(entered(here, state is None)[0])
        yield _batch_of(out, [*kinds, *_WAYS_KINDS[:3]], [*names, *_WAYS[:3]])


def reject_jumps(
    markers: DataFrame,
    keys: list[str],
    time: str,
    percent: str,
    seq: str,
    second: int = 1_000_000_000,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Drop samples that jump too far from the last accepted one.

    Samples are walked in order and constant memory. A large track is cut into
    pieces. Each piece, which also sees the samples of the guard time before it,
    tells for every sample that could be the last accepted one which is the last
    after it; these small tables are composed along the track, and then each
    piece is walked from its true entry. An entry longer ago than the guard time
    is like none.
    """
    session.ship_package(markers.sparkSession)
    plain = markers.withColumn("_t", F.col(time).cast("long")).withColumn(
        "_percent", F.col(percent).cast("double")
    )
    order = ["_t", seq]
    pieces = ordered.find_pieces(plain, keys, order, rows_per_task)
    if pieces.table is None:
        dealt = plain.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order)
        walked = dealt.mapInArrow(lambda it: _accept(it, keys, second, False), plain.schema)
        return walked.select(*markers.columns)

    names = [*keys, ordered.PIECE]
    guard = int(JUMP_GUARD_S * second) + 1
    based = ordered.with_piece(plain, keys, order, pieces).drop("_hot")
    later = based.select(
        *keys, *order, "_percent", F.col(ordered.PIECE).alias("_from"),
        (F.col("_t") + guard).alias("_reach"),
    )
    # the piece in which the guard time after a sample ends
    reach = ordered.with_piece(
        later.withColumnRenamed("_t", "_at").withColumnRenamed("_reach", "_t"), keys, order, pieces
    ).drop("_hot")
    upto = F.greatest(F.col("_from"), F.coalesce(F.col(ordered.PIECE), F.col("_from")))
    seen = reach.withColumn("_seen", F.explode(F.sequence(F.col("_from"), upto))).select(
        *keys,
        F.col("_seen").alias(ordered.PIECE),
        F.col("_at").alias("_t"),
        seq,
        "_percent",
        (F.col("_from") == F.col("_seen")).alias("_own"),
    )
    named = ", ".join(f"`{k}` {seen.schema[k].dataType.simpleString()}" for k in names)
    ways = (
        seen.repartition(*[F.col(n) for n in names])
        .sortWithinPartitions(*names, "_own", *order)
        .mapInArrow(lambda it: _ways(it, names, second), f"{named}, {_WAYS_SCHEMA}")
    )
    entries = (
        ways.repartition(*[F.col(k) for k in keys])
        .sortWithinPartitions(*names)
        .mapInArrow(
            lambda it: _entries(it, keys), f"{named}, _fresh boolean, _entry_t long, _entry_p double"
        )
    )
    # one row for each piece: few, as find_pieces bounds them
    table = entries.toDF(*[f"_e{n}" for n in names], "_fresh", "_entry_t", "_entry_p")
    same = [F.col(n).eqNullSafe(F.col(f"_e{n}")) for n in names]
    entered = based.join(table, same).drop(*[f"_e{n}" for n in names])
    dealt = entered.repartition(*[F.col(n) for n in names]).sortWithinPartitions(*names, *order)
    walked = dealt.mapInArrow(lambda it: _accept(it, names, second, True), entered.schema)
    return walked.select(*markers.columns)
