"""Cutting streams into episodes, and the ends of episodes in exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidline import asof, ordered, session

# Episode limits and thresholds.
DURATION_TOLERANCE_S = 1.0
MAX_DURATION_S = 600.0
CLOSED_SHARE = 0.15
SETTLE_S = 3.0
MAX_EPISODE_ID = 65_534


def pair_start_stop(
    events: DataFrame,
    session: str,
    kind: str,
    time: str,
    seq: str,
    max_duration_s: float = MAX_DURATION_S,
    rows_per_task: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pair the k-th start with the k-th stop of each session.

    Returns the episodes of clean sessions, indexed by start, and one row per
    refused session with its first violated rule.
    """
    marks = events.where(
        F.col(kind).isin("record_start", "record_stop") & F.col(time).isNotNull()
    ).select(session, kind, time, seq)
    small = ordered.whole_if_small(marks, rows_per_task)
    ranked = ordered.scan(
        marks, [session, kind], [time, seq], rows_per_task, small, _rank=ordered.RowNumber()
    )
    pairs = ranked.groupBy(session, "_rank").agg(
        F.max(F.when(F.col(kind) == "record_start", F.col(time))).alias("start_ns"),
        F.max(F.when(F.col(kind) == "record_stop", F.col(time))).alias("end_ns"),
    )
    follow = ordered.scan(
        pairs, [session], ["_rank"], rows_per_task, small, _next=ordered.Lead("start_ns")
    )
    seconds = (F.col("end_ns") - F.col("start_ns")) / 1e9
    judged = follow.withColumn(
        "_rule",
        F.when(F.col("start_ns").isNull() | F.col("end_ns").isNull(), F.lit(1))
        .when((seconds <= 0) | (seconds > max_duration_s + DURATION_TOLERANCE_S), F.lit(2))
        .when(F.col("end_ns") >= F.col("_next"), F.lit(3)),
    )
    names = F.create_map(
        F.lit(1), F.lit("unmatched_events"), F.lit(2), F.lit("invalid_duration"),
        F.lit(3), F.lit("overlap"),
    )
    violations = (
        judged.where(F.col("_rule").isNotNull())
        .groupBy(session)
        .agg(F.min("_rule").alias("_rule"), F.count(F.lit(1)).alias("violations"))
        .select(session, names[F.col("_rule")].alias("reason"), "violations")
    )
    clean = judged.join(violations.select(session), session, "left_anti")
    indexed = ordered.scan(
        clean.select(session, "start_ns", "end_ns"), [], ["start_ns", session], rows_per_task,
        small, _n=ordered.RowNumber(),
    )
    episodes = indexed.select(
        (F.col("_n") - 1).alias("episode_index"), session, "start_ns", "end_ns"
    )
    return episodes, violations


def closed_windows(
    events: DataFrame,
    session: str,
    kind: str,
    order: list[str],
    time: str,
    rows_per_task: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Recording windows by walking the events of each session in order.

    A stop without a start is ignored and an open tail dropped. A start inside
    a window or a window without length makes the whole session invalid.
    Returns the windows of valid sessions and the sessions refused or open.
    """
    marks = events.where(F.col(kind).isin("record_start", "record_stop"))
    step = ordered.scan(
        marks, [session], order, rows_per_task,
        _kind=ordered.Lead(kind), _end=ordered.Lead(time),
    )
    starts = step.where(F.col(kind) == "record_start").withColumn(
        "_state",
        F.when(F.col("_kind").isNull(), F.lit("open"))
        .when(F.col("_kind") == "record_start", F.lit("nested_start"))
        .when(F.col("_end") <= F.col(time), F.lit("no_length"))
        .otherwise(F.lit("closed")),
    )
    sessions = (
        starts.groupBy(session)
        .agg(
            F.bool_or(F.col("_state") == "nested_start").alias("nested_start"),
            F.bool_or(F.col("_state") == "no_length").alias("no_length"),
            F.bool_or(F.col("_state") == "open").alias("open_tail"),
        )
        .where(F.col("nested_start") | F.col("no_length") | F.col("open_tail"))
    )
    refused = sessions.where(F.col("nested_start") | F.col("no_length"))
    windows = (
        starts.where(F.col("_state") == "closed")
        .join(refused.select(session), session, "left_anti")
        .select(session, F.col(time).alias("start_ns"), F.col("_end").alias("end_ns"))
    )
    return windows, sessions


def fallback_episodes(
    primary: DataFrame, others: list[DataFrame], keys: list[str], time: str, active: str
) -> DataFrame:
    """One episode per run: the span of recorded rows, else of all streams."""
    merged = primary.select(*keys, time, F.coalesce(active, F.lit(False)).alias("_active"))
    for other in others:
        merged = merged.unionByName(other.select(*keys, time, F.lit(False).alias("_active")))
    on = F.when(F.col("_active"), F.col(time))
    return merged.groupBy(*keys).agg(
        F.coalesce(F.min(on), F.min(time)).alias("start_ns"),
        F.coalesce(F.max(on), F.max(time)).alias("end_ns"),
        F.when(F.bool_or("_active"), F.lit("recording_flag"))
        .otherwise(F.lit("full_available_range"))
        .alias("source"),
    )


def closed_threshold(
    rows: DataFrame, keys: list[str], width: str, absolute: float | None = None
) -> DataFrame:
    """Width below which the gripper counts as closed."""
    low, high = F.min(width), F.max(width)
    value = F.lit(absolute) if absolute is not None else low + (high - low) * CLOSED_SHARE
    return rows.groupBy(*keys).agg(value.alias("closed_threshold"))


def effective_start(
    rows: DataFrame,
    thresholds: DataFrame,
    keys: list[str],
    time: str,
    width: str,
    settle: float,
) -> DataFrame:
    """First time the gripper is closed, plus the settling time.

    Keys that never close have a null start and status ``no_close_event``.
    """
    hit = F.min(F.when(F.col(width) <= F.col("closed_threshold"), F.col(time)))
    return (
        rows.join(thresholds, keys)
        .groupBy(*keys)
        .agg(hit.alias("first_closed"))
        .select(
            *keys,
            "first_closed",
            (F.col("first_closed") + settle).alias("effective_start"),
            F.when(F.col("first_closed").isNull(), F.lit("no_close_event"))
            .otherwise(F.lit("ok"))
            .alias("status"),
        )
    )


def forward_windows(
    rows: DataFrame, keys: list[str], time: str, fields: list[str], window: int
) -> DataFrame:
    """n, incomplete, and <field>_min, _max, _sum over ``[t, t + window]`` for every time of a key.

    ``incomplete`` counts rows in which a field is null.

    Time is cut into blocks as wide as the window, so a window is the rest of its
    block and the beginning of the next one. Each row counts in its own block, and
    asks the next block, at its window's end, for what came until then. Running
    values in either direction answer both, so the work does not depend on how
    many rows a window holds, and a block of a key is all that a task orders.
    """
    ask = F.struct((F.col(time) + window).alias("_at"), F.lit(False).alias("_own"))
    own = F.struct(F.col(time).alias("_at"), F.lit(True).alias("_own"))
    placed = rows.select(*keys, *[F.col(f).cast("double").alias(f) for f in fields], F.inline(F.array(own, ask)))
    placed = placed.withColumn("_block", ordered.floor_div(F.col("_at"), window))
    part = Window.partitionBy(*keys, "_block")
    # frames by value: rows of equal times see each other
    upto = part.orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onwards = part.orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    null = F.lit(False)
    for f in fields:
        null = null | F.col(f).isNull()

    def running(frame) -> list[Column]:
        known = [(F.min, "min"), (F.max, "max"), (F.sum, "sum")]
        return [
            F.count_if("_own").over(frame).alias("n"),
            F.count_if(F.col("_own") & null).over(frame).alias("incomplete"),
            *[
                how(F.when(F.col("_own"), F.col(f))).over(frame).alias(f"{f}_{name}")
                for f in fields
                for how, name in known
            ],
        ]

    both = placed.select(
        *keys,
        "_own",
        F.when(F.col("_own"), F.col("_at")).otherwise(F.col("_at") - window).alias(time),
        F.struct(*running(onwards)).alias("_rest"),
        F.struct(*running(upto)).alias("_begun"),
    )
    half = F.when(F.col("_own"), F.col("_rest")).otherwise(F.col("_begun"))
    halves = both.select(*keys, time, "_own", half.alias("_half"))
    # all rows of one time have the same halves
    met = halves.groupBy(*keys, time).agg(
        F.any_value(F.when(F.col("_own"), F.col("_half")), True).alias("_a"),
        F.any_value(F.when(~F.col("_own"), F.col("_half")), True).alias("_b"),
    )

    def plus(name: str) -> Column:
        return F.coalesce(F.col("_a")[name], F.lit(0)) + F.coalesce(F.col("_b")[name], F.lit(0))

    return met.select(
        *keys,
        time,
        plus("n").alias("n"),
        plus("incomplete").alias("incomplete"),
        *[
            column
            for f in fields
            for column in (
                F.least(F.col("_a")[f"{f}_min"], F.col("_b")[f"{f}_min"]).alias(f"{f}_min"),
                F.greatest(F.col("_a")[f"{f}_max"], F.col("_b")[f"{f}_max"]).alias(f"{f}_max"),
                plus(f"{f}_sum").alias(f"{f}_sum"),
            )
        ],
    )


MARGIN = 1e-9  # rounding may not decide what bounds decide


def stillness(windows: DataFrame, limits: list[tuple[list[str], float]]) -> Column:
    """True or false where bounds decide whether a window is still, else null.

    For each group of fields the largest distance from the mean must stay below
    its limit. It is at least the largest extent of one field around the mean,
    and at most the root of the sum of their squares.
    """
    sure, out = F.lit(True), (F.col("n") <= 1) | (F.col("incomplete") > 0)
    for fields, limit in limits:
        extents = []
        for f in fields:
            mean = F.col(f"{f}_sum") / F.col("n")
            extents.append(F.greatest(F.col(f"{f}_max") - mean, mean - F.col(f"{f}_min")))
        least = F.greatest(*extents) if len(extents) > 1 else extents[0]
        most = F.sqrt(sum((e * e for e in extents[1:]), extents[0] * extents[0]))
        sure = sure & (most < limit * (1 - MARGIN))
        out = out | (least >= limit * (1 + MARGIN))
    return F.when(out, F.lit(False)).when(sure, F.lit(True))


def _settled(
    rows: DataFrame, open_: DataFrame, keys: list[str], time: str, window: int,
    limits: list[tuple[list[str], float]],
) -> DataFrame:
    """Those of the open windows that are still, by the distances of all their rows."""
    fields = [f for group, _ in limits for f in group]
    means = [(F.col(f"{f}_sum") / F.col("n")).alias(f"{f}_mean") for f in fields]
    block = ordered.floor_div(F.col("_from"), window)
    asked = open_.select(*keys, F.col(time).alias("_from"), *means).withColumn(
        "_block", F.explode(F.array(block, block + 1))
    )
    placed = rows.select(*keys, time, *fields, ordered.floor_div(F.col(time), window).alias("_block"))
    inside = placed.join(asked, [*keys, "_block"]).where(
        F.col(time).between(F.col("_from"), F.col("_from") + window)
    )
    far = {}
    for k, (group, _) in enumerate(limits):
        square = sum(
            (F.pow(F.col(f) - F.col(f"{f}_mean"), F.lit(2.0)) for f in group[1:]),
            F.pow(F.col(group[0]) - F.col(f"{group[0]}_mean"), F.lit(2.0)),
        )
        far[f"_far{k}"] = F.sqrt(F.max(square))
    found = inside.groupBy(*keys, "_from").agg(*[c.alias(n) for n, c in far.items()])
    for k, (_, limit) in enumerate(limits):
        found = found.where(F.col(f"_far{k}") < limit)
    return found.select(*keys, F.col("_from").alias(time))


def judged_windows(
    rows: DataFrame,
    starts: DataFrame,
    keys: list[str],
    time: str,
    limits: list[tuple[list[str], float]],
    window: int,
    min_duration: int,
) -> DataFrame:
    """Forward windows of all candidates with ``_still``: true, false, or null for open ones."""
    # rows before the first candidate are in no forward window
    late = rows.join(starts.select(*keys, "effective_start"), keys).where(
        F.col(time) >= F.col("effective_start") + min_duration
    )
    fields = [f for group, _ in limits for f in group]
    ahead = forward_windows(late, keys, time, fields, window)
    return ahead.withColumn("_still", stillness(ahead, limits))


def effective_end(
    rows: DataFrame,
    starts: DataFrame,
    keys: list[str],
    time: str,
    position: list[str],
    rotation: list[str],
    window: int,
    min_duration: int,
    max_translation: float,
    max_rotation: float,
) -> DataFrame:
    """First time from which the pose stays still for ``window``, else the last time.

    Bounds settle most windows. Exact distances are computed only for windows
    that bounds leave open and that start before the first one they accept.
    """
    limits = [(position, max_translation), (rotation, max_rotation)]
    judged = judged_windows(rows, starts, keys, time, limits, window, min_duration)
    judged = session.materialise(rows.sparkSession, judged, "windows")
    sure = judged.where("_still").groupBy(*keys).agg(F.min(time).alias("_sure"))
    open_ = open_windows(judged, sure, keys, time)
    exact = _settled(rows, open_, keys, time, window, limits).groupBy(*keys).agg(
        F.min(time).alias("_exact")
    )
    last = rows.groupBy(*keys).agg(F.max(time).alias("_last"))
    found = F.least("_sure", "_exact")
    return last.join(sure, keys, "left").join(exact, keys, "left").select(
        *keys,
        F.coalesce(found, "_last").alias("effective_end"),
        F.when(found.isNotNull(), F.lit("stable_pose_window"))
        .otherwise(F.lit("fallback_end_of_sequence"))
        .alias("status"),
    )


def open_windows(judged: DataFrame, sure: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Windows that need exact distances: open ones before the first accepted one."""
    before = F.col("_sure").isNull() | (F.col(time) < F.col("_sure"))
    return judged.where("_still IS NULL").join(sure, keys, "left").where(before)


def clamp_episode_id(df: DataFrame, column: str) -> DataFrame:
    """Ids outside 0..65534 become 0."""
    ok = F.col(column).between(0, MAX_EPISODE_ID)
    return df.withColumn(column, F.coalesce(F.when(ok, F.col(column)), F.lit(0)).cast("long"))


def ends_at_changes(
    rows: DataFrame, order: list[str], episode: str, rows_per_task: int | None = None
) -> DataFrame:
    """Exclusive end offset of every run of equal ids in export order."""
    walked = ordered.scan(
        rows.select(*order, *([] if episode in order else [episode])), [], order, rows_per_task,
        _n=ordered.RowNumber(), _next=ordered.Lead(episode),
    )
    return walked.where(F.col("_next").isNull() | (F.col("_next") != F.col(episode))).select(
        episode, F.col("_n").alias("episode_end")
    )


def ends_by_id(rows: DataFrame, episode: str, rows_per_task: int | None = None) -> DataFrame:
    """Running row count over distinct ids in id order."""
    sizes = rows.groupBy(episode).agg(F.count(F.lit(1)).alias("_n"))
    summed = ordered.scan(sizes, [], [episode], rows_per_task, episode_end=ordered.RunSum("_n"))
    return summed.select(episode, "episode_end")


def cumulative_lengths(
    lengths: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Running lengths per stream over the episodes of a dataset."""
    return ordered.scan(
        lengths, keys, order, rows_per_task,
        **{f"{c}_len": ordered.RunSum(c) for c in columns},
    )


def preroll_slice(
    samples: DataFrame,
    events: DataFrame,
    keys: list[str],
    time: str,
    start: str,
    end: str,
    preroll: int,
    bin_width: int,
) -> DataFrame:
    """Samples from ``preroll`` before an event's start up to its end; no start, no rows."""
    windows = events.withColumn("_from", F.col(start) - preroll)
    return asof.windows_join(samples, windows, keys, time, "_from", end, bin_width).drop("_from")


def manual_trim(
    episodes: DataFrame, overrides: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Reviewer's values where ``use_manual_trim`` is set and a value is given."""
    given = overrides.select(
        *keys, *[F.when(F.col("use_manual_trim"), F.col(c)).alias(f"_m_{c}") for c in columns]
    )
    return episodes.join(given, keys, "left").select(
        *[
            F.coalesce(f"_m_{c}", c).alias(c) if c in columns else F.col(c)
            for c in episodes.columns
        ]
    )


def archive_generations(
    connections: DataFrame,
    session: str,
    first: str,
    committed: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Number the archives of a session.

    A connection whose first sequence is beyond the last committed one plus one
    cannot continue the archive and opens a new generation; the missing frames
    are counted. Sequences of a session only move forward.
    """
    order = [first, committed]
    pieces = ordered.find_pieces(connections, [session], order, rows_per_task)
    seen = ordered.scan(
        connections, [session], order, pieces=pieces, _seen=ordered.RunMax(committed, strict=True)
    )
    gap = F.greatest(F.lit(0).cast("long"), F.col(first) - F.col("_seen") - 1)
    opened = seen.withColumn("missing_sequences", F.coalesce(gap, F.lit(0).cast("long"))).withColumn(
        "_new", (F.col("missing_sequences") > 0).cast("long")
    )
    return ordered.scan(
        opened, [session], order, pieces=pieces, generation=ordered.RunSum("_new")
    ).drop("_seen", "_new")
