"""From normalised tables to gated, exported training rows, for all episodes at once.

Stages are functions of tables. A gate never stops the job: its verdicts are a
table, and the episodes it objects to leave by an anti join. Gates in order:
input, normalization, alignment, media, export; an episode's state names the
first one that refuses it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidline import asof, session
from braidline.functions import se3
from braidline.operators import episodes, filters, gates, statistics
from braidline.plans import alignment, training
from braidline.sources import sinks

EPISODE = ["run_id", "episode_index"]
STREAMS = ["frames", "camera", "force"]
GATES = ["input", "normalization", "alignment", "media", "export"]
CAMERA_NUMBERS = {"color": "color_frame_number", "depth": "depth_frame_number"}


@dataclass(frozen=True)
class Settings:
    """``target_fps`` asks for a timeline of ticks; without it the frames are the targets."""

    target_fps: float | None = None
    frame_max_ms: float = alignment.FRAME_MAX_MS
    camera_max_ms: float = alignment.CAMERA_MAX_MS
    force_max_ms: float = alignment.FORCE_MAX_MS
    max_duration_s: float = episodes.MAX_DURATION_S
    min_valid_ratio: float = gates.MIN_VALID_RATIO
    #: media that must not be missing from exported rows; phone_depth is for runs that record it
    media: tuple[str, ...] = ("phone_image", "camera_image", "camera_depth")
    max_missing_media: float = gates.MAX_MISSING_MEDIA
    window_bin_ns: int = 60_000_000_000
    rows_per_task: int | None = None


@dataclass(frozen=True)
class Result:
    """Tables of one run of the stages.

    Episodes and timeline are written to the shared folder as they are made, so
    that later stages, and tasks that are run again, read them instead of
    computing them anew.
    """

    episodes: DataFrame
    refused_sessions: DataFrame
    timeline: DataFrame
    #: the alignment gate with its ratios
    verdicts: DataFrame
    training: DataFrame
    #: run_id, episode_index, gate, ok, reasons of all gates
    gates: DataFrame
    #: per episode the first gate that refuses it, or ``complete``
    states: DataFrame
    #: counts of every stage as tall rows
    report: DataFrame
    #: exported episodes with their spans, lengths and dense index
    manifest: DataFrame


def in_episodes(
    rows: DataFrame, windows: DataFrame, keys: list[str], time: str, bin_ns: int
) -> DataFrame:
    """Rows that fall into an episode of their key, with its index."""
    return asof.windows_join(rows, windows, keys, time, "start_ns", "end_ns", bin_ns)


def stream_counts(
    frames: DataFrame,
    events: DataFrame,
    camera: DataFrame,
    force: DataFrame,
    windows: DataFrame,
    bin_ns: int,
) -> DataFrame:
    """Rows of each stream inside each episode, as the normalization gate wants them.

    Every episode has a row. Whether the camera is unbroken is a property of the
    run's whole files; without frame numbers it counts as unbroken.
    """
    marks = events.where(F.col("event").isin("record_start", "record_stop"))
    both = F.col("left_wrench").isNotNull() & F.col("right_wrench").isNotNull()
    parts = {
        "frames": (frames, ["run_id", "session_id"], F.lit(True)),
        "events": (marks, ["run_id", "session_id"], F.lit(True)),
        "camera": (camera, ["run_id"], F.lit(True)),
        "force": (force, ["run_id"], both),
    }
    tall = None
    for name, (rows, keys, calibrated) in parts.items():
        at = windows.select(*keys, "episode_index", "start_ns", "end_ns")
        narrow = rows.select(*keys, "aligned_ns", calibrated.alias("_calibrated"))
        inside = in_episodes(narrow, at, keys, "aligned_ns", bin_ns)
        one = inside.select(*EPISODE, F.lit(name).alias("stream"), "_calibrated")
        tall = one if tall is None else tall.unionByName(one)
    counted = tall.groupBy(*EPISODE).agg(
        *[F.count_if(F.col("stream") == n).alias(n) for n in parts],
        F.count_if((F.col("stream") == "force") & F.col("_calibrated")).alias("calibrated_samples"),
    )
    zero = F.lit(0).cast("long")
    filled = windows.select(*EPISODE).join(counted, EPISODE, "left").select(
        *EPISODE,
        F.coalesce("frames", zero).alias("frames"),
        F.coalesce("events", zero).alias("events"),
        F.coalesce("camera", zero).alias("camera_frames"),
        F.coalesce("force", zero).alias("samples"),
        F.coalesce("calibrated_samples", zero).alias("calibrated_samples"),
    )
    sides = {n: c for n, c in CAMERA_NUMBERS.items() if c in camera.columns}
    if not sides:
        return filled.withColumn("camera_ok", F.lit(True))
    per_file = statistics.frame_integrity(
        camera, ["run_id", "source_file"], ["frame_index"], sides
    )
    whole = statistics.integrity_total(per_file, ["run_id"]).select("run_id", F.col("ok").alias("camera_ok"))
    return filled.join(whole, "run_id", "left").withColumn(
        "camera_ok", F.coalesce("camera_ok", F.lit(True))
    )


def input_verdicts(counts: DataFrame) -> DataFrame:
    """The input gate over counts of streams."""
    names = {"frames": "frames", "camera": "camera_frames", "force": "samples"}
    present = counts.select(
        *EPISODE,
        F.explode(
            F.array(F.lit(""), *[F.when(F.col(c) > 0, F.lit(n)) for n, c in names.items()])
        ).alias("stream"),
    )
    return gates.input_gate(present, EPISODE, "stream", STREAMS)


MEDIA = {
    "phone_image": "rgb.valid",
    "phone_depth": "depth.valid",
    "camera_image": "camera.valid",
    "camera_depth": "camera.row.depth_byte_offset IS NOT NULL",
}


def media_counts(rows: DataFrame, windows: DataFrame, media: tuple[str, ...]) -> DataFrame:
    """Exported rows of every episode, and those without each medium."""
    counted = rows.groupBy(*EPISODE).agg(
        F.count(F.lit(1)).alias("image_rows"),
        *[F.count_if(~F.coalesce(F.expr(MEDIA[m]), F.lit(False))).alias(f"missing_{m}") for m in media],
    )
    return windows.select(*EPISODE).join(counted, EPISODE, "left")


def episode_states(verdicts: DataFrame) -> DataFrame:
    """Per episode the first gate that refuses it, its reasons, or ``complete``."""
    place = F.array_position(F.array(*[F.lit(g) for g in GATES]), F.col("gate"))
    first = F.min_by(
        F.struct("gate", "reasons"), F.when(~F.col("ok"), place)
    )
    return verdicts.groupBy(*EPISODE).agg(first.alias("_first")).select(
        *EPISODE,
        F.coalesce("_first.gate", F.lit("complete")).alias("state"),
        F.coalesce("_first.reasons", F.lit("")).alias("reasons"),
    )


def postprocess(
    frames: DataFrame,
    events: DataFrame,
    camera: DataFrame,
    force: DataFrame,
    settings: Settings = Settings(),
    exclusions: DataFrame | None = None,
) -> Result:
    """Episodes, aligned timeline, verdicts of all gates, training rows, report and manifest.

    (E1, J1, J4, A16-A20, F2-F7, K5, K9, K10)

    All tables carry run_id; frames and events also session_id. ``frames`` and
    ``camera`` come from ``plans.normalize``; ``force`` holds left_wrench and
    right_wrench. ``exclusions`` lists session_id to leave out.
    """
    s = settings
    marks = events.withColumn("session_key", F.concat_ws("/", "run_id", "session_id"))
    if exclusions is not None:
        marks = filters.without_excluded(marks, exclusions, "session_id")
    found, refused = episodes.pair_start_stop(
        marks, "session_key", "event", "aligned_ns", "sequence", s.max_duration_s, s.rows_per_task
    )
    named = found.join(
        marks.select("session_key", "run_id", "session_id").distinct(), "session_key"
    ).drop("session_key")
    spark = frames.sparkSession
    named = session.materialise(spark, named, "episodes")

    windows = named.select("run_id", "session_id", "episode_index", "start_ns", "end_ns")
    reach = int(max(s.frame_max_ms, s.camera_max_ms, s.force_max_ms) * 1e6)
    wide = windows.withColumn("start_ns", F.col("start_ns") - reach).withColumn(
        "end_ns", F.col("end_ns") + reach
    )

    def stream(rows: DataFrame, seq: str, keys: list[str]) -> asof.Stream:
        # the early clip keeps samples that no target could use out of the shuffle
        at = wide.select(*keys, "episode_index", "start_ns", "end_ns")
        inside = in_episodes(rows, at, keys, "aligned_ns", s.window_bin_ns)
        return asof.Stream(inside.drop("start_ns", "end_ns"), "aligned_ns", seq)

    session_keys = ["run_id", "session_id"]
    if s.target_fps:
        ticks = alignment.uniform_targets(windows, EPISODE, "start_ns", "end_ns", s.target_fps)
        targets = ticks.withColumnRenamed("t", "aligned_ns")
        phone = stream(frames, "sequence", session_keys)
    else:
        at = windows.select(*session_keys, "episode_index", "start_ns", "end_ns")
        targets = in_episodes(frames, at, session_keys, "aligned_ns", s.window_bin_ns)
        targets, phone = targets.drop("start_ns", "end_ns"), None
    timeline = alignment.align(
        targets,
        stream(camera, "frame_index", ["run_id"]),
        stream(force, "packet_index", ["run_id"]),
        EPISODE,
        "aligned_ns",
        "tick" if s.target_fps else "sequence",
        s.camera_max_ms,
        s.force_max_ms,
        pair_valid="rgb_depth_pair_valid",
        rows_per_task=s.rows_per_task,
        phone=phone,
        phone_max_ms=s.frame_max_ms,
    )
    if s.target_fps:
        # a tick shows the frame it was matched to
        known = [c for c in frames.columns if c not in (*EPISODE, "aligned_ns")]
        timeline = timeline.select("*", *[F.col(f"frame.row.{c}").alias(c) for c in known])
        timeline = timeline.withColumn("frame", F.col("frame").dropFields("row"))
    timeline = session.materialise(spark, timeline, "timeline")
    counts = alignment.alignment_counts(timeline, EPISODE)
    # a frame that comes twice, or is nearest to two ticks, is reused
    used = F.when(F.col("frame.valid"), F.col("sequence"))
    frames_used = timeline.groupBy(*EPISODE).agg(
        (F.count(used) - F.count_distinct(used)).alias("duplicate_targets"),
    )
    measured = windows.select(*EPISODE).join(counts.join(frames_used, EPISODE), EPISODE, "left")
    measured = session.materialise(spark, measured, "alignment-counts")
    verdicts = gates.alignment_gate(
        measured,
        EPISODE,
        ["frame_valid", "camera_valid", "force_valid", "all_valid"],
        s.min_valid_ratio,
    )
    streams = stream_counts(frames, events, camera, force, windows, s.window_bin_ns)
    streams = session.materialise(spark, streams, "stream-counts")
    found = {
        "input": input_verdicts(streams),
        "normalization": gates.normalization_gate(streams, EPISODE),
        "alignment": verdicts,
    }
    exportable = timeline.where(
        filters.strictly_exportable([F.col("all_valid")], F.col("pose"))
    )
    media = session.materialise(spark, media_counts(exportable, windows, s.media), "media-counts")
    found["media"] = gates.media_gate(
        media, EPISODE, "image_rows", [f"missing_{m}" for m in s.media], s.max_missing_media
    )
    told = [v.select(*EPISODE, F.lit(n).alias("gate"), "ok", "reasons") for n, v in found.items()]
    before = told[0]
    for one in told[1:]:
        before = before.unionByName(one)
    before = session.materialise(spark, before, "verdicts")

    kept = gates.passing(exportable, before, EPISODE)
    matrix = F.col("pose.camera_in_user_world")
    turn = se3.rotation_to_rpy_deg(se3.rotation_of(se3.cells(matrix, 4, 4)))
    place = se3.translation_of(se3.cells(matrix, 4, 4))
    pos = F.array(*[p * 1000.0 for p in place], *[F.radians(a) for a in turn])
    rows = training.flat_table(
        kept,
        EPISODE,
        ["aligned_ns", "sequence"],
        pos,
        F.array("force.left_wrench", "force.right_wrench"),
        F.col("gripper.open_percent"),
        rows_per_task=s.rows_per_task,
    )
    numbered = kept.withColumnRenamed("episode_index", "source_episode_index")
    lengths = {f"{m}_len": F.expr(MEDIA[m]) for m in s.media}
    flagged = numbered.withColumns(lengths)
    manifest = sinks.export_manifest(
        flagged, "run_id", "source_episode_index", "aligned_ns",
        {"rows_len": F.lit(True), **{n: F.col(n) for n in lengths}}, s.rows_per_task,
    )
    manifest = session.materialise(spark, manifest, "manifest")
    wanted = before.groupBy(*EPISODE).agg(F.every("ok").alias("ok")).where("ok").select(*EPISODE)
    mapped = manifest.select("run_id", F.col("source_episode_index").alias("episode_index"))
    exported = gates.export_gate(wanted, mapped, EPISODE)
    every = before.unionByName(
        exported.select(*EPISODE, F.lit("export").alias("gate"), "ok", "reasons")
    )
    report = sinks.stage_report("normalize", EPISODE, streams, {})
    for stage, table in (("align", measured), ("export", media)):
        report = report.unionByName(sinks.stage_report(stage, EPISODE, table, {}))
    limits = {
        "frame_max_ms": s.frame_max_ms, "camera_max_ms": s.camera_max_ms,
        "force_max_ms": s.force_max_ms, "min_valid_ratio": s.min_valid_ratio,
    }
    report = report.withColumns({f"setting_{k}": F.lit(float(v)) for k, v in limits.items()})
    return Result(
        named, refused, timeline, verdicts, rows, every, episode_states(every), report, manifest
    )
