"""Writing tables: atomic streams, incremental episodes, registries, manifests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidline import ordered
from braidline.operators import relations, statistics
from braidline.sources.episodes import EpisodeTable, _rows_seen


def write_stream(rows: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Write through Spark's committer and return the row count of the same pass. (K1)"""
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.format(fmt).mode(mode).save(path)
    return _rows_seen(seen)


def write_episodes(rows: DataFrame, path: str, keys: list[str] | None = None) -> int:
    """Append or replace exactly the episodes in ``rows`` as one commit. (K2)"""
    return EpisodeTable(rows.sparkSession, path, keys).write(rows)


INDEX_COLUMNS = [
    "global_sample_index",
    "episode_index",
    "sample_index",
    "aligned_ns",
    "frame_sequence",
    "frame_path",
    "camera_frame_index",
    "camera_delta_ms",
    "force_packet_index",
    "force_delta_ms",
    "frame_valid",
    "camera_valid",
    "force_valid",
    "all_valid",
]


def aligned_index(
    timeline: DataFrame,
    episode: str,
    time: str,
    seq: str,
    frame_path: str,
    camera_id: str,
    force_id: str,
    rows_per_task: int | None = None,
    frame_seq: str | None = None,
) -> DataFrame:
    """The flat 14-column index of a timeline. (K3)

    ``seq`` ranks targets of equal times; ``frame_seq`` names the frame, if
    that is another column, as on a timeline of ticks.
    """
    small = ordered.whole_if_small(timeline, rows_per_task)
    local = ordered.scan(
        timeline, [episode], [time, seq], rows_per_task, small, _i=ordered.RowNumber()
    )
    every = ordered.scan(
        local, [], [episode, "_i"], rows_per_task, small, _g=ordered.RowNumber()
    )
    return every.select(
        (F.col("_g") - 1).alias("global_sample_index"),
        F.col(episode).alias("episode_index"),
        (F.col("_i") - 1).alias("sample_index"),
        F.col(time).alias("aligned_ns"),
        F.col(frame_seq or seq).alias("frame_sequence"),
        F.col(frame_path).alias("frame_path"),
        F.col(f"camera.row.{camera_id}").alias("camera_frame_index"),
        F.col("camera.source_delta_ms").alias("camera_delta_ms"),
        F.col(f"force.row.{force_id}").alias("force_packet_index"),
        F.col("force.source_delta_ms").alias("force_delta_ms"),
        F.col("frame.valid").alias("frame_valid"),
        F.col("camera.valid").alias("camera_valid"),
        F.col("force.valid").alias("force_valid"),
        "all_valid",
    )


def write_debug_json(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Timeline, episodes and report as JSON lines below one folder. (K4)"""
    return {
        name: write_stream(df, f"{path}/{name}", "json") for name, df in tables.items()
    }


SEMANTICS = {
    "action": "next_pose_minus_pose_inside_episode_zero_tail",
    "gripper_action": "next_binary_state_inside_episode_repeat_tail",
    "pos_units": "mm,mm,mm,rad,rad,rad",
}


def write_training_table(rows: DataFrame, path: str, episode: str) -> DataFrame:
    """Write the flat table with its semantics as column metadata; return rows per episode. (K5)"""
    told = [
        F.col(c).alias(c, metadata={"semantics": SEMANTICS[c]}) if c in SEMANTICS else F.col(c)
        for c in rows.columns
    ]
    rows.select(*told).write.mode("overwrite").parquet(path)
    return (
        rows.sparkSession.read.parquet(path)
        .groupBy(episode)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def normalizer_table(rows: DataFrame, vectors: dict[str, int]) -> DataFrame:
    """Minimum and maximum per dimension of each vector column, as one small table. (K6)"""
    flat = {
        f"{name}_{i}": F.get(name, F.lit(i)) for name, size in vectors.items() for i in range(size)
    }
    wide = statistics.minmax(rows.select(*[c.alias(n) for n, c in flat.items()]), [], list(flat))
    entries = [
        F.struct(
            F.lit(name.rsplit("_", 1)[0]).alias("name"),
            F.lit(int(name.rsplit("_", 1)[1])).alias("dim"),
            F.col(f"{name}_min").alias("min"),
            F.col(f"{name}_max").alias("max"),
        )
        for name in flat
    ]
    return wide.select(F.inline(F.array(*entries)))


REGISTRY_SCHEMA = "run_id string, stream string, role string, path string, updated_at timestamp, metadata string"


def register_artifact(
    spark: SparkSession, table: str, run_id: str, stream: str, role: str, path: str, metadata: dict
) -> None:
    """Append one registry row; nothing is rewritten. (K7)"""
    row = spark.createDataFrame(
        [(run_id, stream, role, path, json.dumps(metadata, sort_keys=True))],
        "run_id string, stream string, role string, path string, metadata string",
    )
    row.withColumn("updated_at", F.current_timestamp()).select(
        *T.StructType.fromDDL(REGISTRY_SCHEMA).names
    ).write.mode("append").parquet(table)


def latest_artifacts(registry: DataFrame) -> DataFrame:
    """The newest row per run, stream and role. (K7)"""
    return relations.latest_by(registry, ["run_id", "stream", "role"], ["updated_at", "path"])


def delete_episodes(
    index: DataFrame,
    deleted: DataFrame,
    run: str,
    source_episode: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """The episode index without the deleted ones, later ones moved up. (K8)

    Only this small table changes; the data of the kept episodes is not touched.
    """
    kept = index.join(deleted.select(run, source_episode).distinct(), [run, source_episode], "left_anti")
    ranked = ordered.scan(kept, [run], [source_episode], rows_per_task, _n=ordered.RowNumber())
    return ranked.withColumn("episode_index", F.col("_n") - 1).drop("_n")


def export_manifest(
    rows: DataFrame, run: str, source_episode: str, time: str, lengths: dict[str, str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Per episode: span, rows per stream and its logical index; lengths also run up. (K9)

    ``lengths`` maps a length's name to the flag column it counts.
    """
    summary = rows.groupBy(run, source_episode).agg(
        F.min(time).alias("start_ns"),
        F.max(time).alias("end_ns"),
        *[F.count_if(F.coalesce(flag, F.lit(False))).alias(n) for n, flag in lengths.items()],
    )
    ranked = ordered.scan(
        summary, [run], [source_episode], rows_per_task,
        _n=ordered.RowNumber(), **{f"{n}_total": ordered.RunSum(n) for n in lengths},
    )
    return ranked.withColumn("episode_index", F.col("_n") - 1).drop("_n")


def stage_report(
    stage: str, keys: list[str], counts: DataFrame, settings: dict[str, float]
) -> DataFrame:
    """Counts and settings of a stage as tall report rows."""
    names = [c for c in counts.columns if c not in keys]
    tall = counts.select(*keys, *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        keys, names, "metric", "value"
    )
    out = tall.withColumn("stage", F.lit(stage))
    for name, value in settings.items():
        out = out.withColumn(f"setting_{name}", F.lit(float(value)))
    return out


def split_sides(
    rows: DataFrame, keep: list[str], offsets: DataFrame | None = None, keys: list[str] | None = None
) -> DataFrame:
    """Dual-sensor rows as one row per side, raw or minus each side's offset.

    ``offsets`` has ``keys``, side and an ``offset`` array per side. Write the
    result with ``partitionBy("side")``.
    """
    sides = F.inline(
        F.array(
            F.struct(F.lit("LF").alias("side"), F.col("left_raw").alias("channels")),
            F.struct(F.lit("RF").alias("side"), F.col("right_raw").alias("channels")),
        )
    )
    tall = rows.select(*keep, sides)
    if offsets is None:
        return tall
    joined = tall.join(offsets, [*(keys or []), "side"], "left")
    return joined.withColumn(
        "channels", F.zip_with("channels", "offset", lambda c, o: c - o)
    ).drop("offset")
