"""Quality gates over all episodes at once, reports and the dataset catalog.

A gate returns one row per episode with ``ok`` and the reasons against it; bad
episodes are taken out by an anti join and never stop the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the gates.
MIN_VALID_RATIO = 0.8
MAX_DUPLICATE_RATIO = 0.05
MAX_MISSING_MEDIA = 0.2


def _verdict(df: DataFrame, keys: list[str], rules: dict[str, Column], *extra: Column) -> DataFrame:
    """Add ``ok`` and the comma-separated names of the rules that hold against a row."""
    found = [
        F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in rules.items()
    ]
    reasons = F.array_compact(F.array(*found))
    return df.select(
        *keys,
        *extra,
        (F.size(reasons) == 0).alias("ok"),
        F.array_join(reasons, ",").alias("reasons"),
    )


def count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def export_quality(
    timeline: DataFrame, keys: list[str], flags: dict[str, Column], exported: Column
) -> DataFrame:
    """Share of rows per flag, and of exported rows."""

    def share(x: Column) -> Column:
        return F.avg(F.coalesce(x, F.lit(False)).cast("int"))

    return timeline.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("timeline_rows"),
        F.count_if(exported).alias("exported_rows"),
        share(exported).alias("exported_ratio"),
        *[share(c).alias(f"{name}_ratio") for name, c in flags.items()],
    )


def normalization_gate(report: DataFrame, keys: list[str]) -> DataFrame:
    """Every stream present, one start-stop pair, unbroken camera, calibrated force.

    Columns: frames, events, camera_frames, camera_ok, samples, calibrated_samples.
    """
    return _verdict(
        report,
        keys,
        {
            "frames_missing": count("frames") <= 0,
            "not_one_start_stop_pair": count("events") != 2,
            "camera_frames_missing": count("camera_frames") <= 0,
            "camera_discontinuous": ~F.col("camera_ok"),
            "force_samples_missing": count("samples") <= 0,
            "calibrated_samples_missing": count("calibrated_samples") <= 0,
        },
    )


def alignment_gate(
    counts: DataFrame, keys: list[str], streams: list[str], min_ratio: float = MIN_VALID_RATIO
) -> DataFrame:
    """Valid ratios high enough and few reused target frames.

    Columns: timeline_rows, <stream> counts, duplicate_targets.
    """
    rows = F.col("timeline_rows")
    ratio = {s: count(s) / F.nullif(rows, F.lit(0)) for s in streams}
    duplicates = count("duplicate_targets") / F.nullif(rows, F.lit(0))
    rules = {"no_rows": count("timeline_rows") <= 0}
    rules |= {f"{s}_ratio_low": r < min_ratio for s, r in ratio.items()}
    rules["duplicate_targets"] = duplicates > MAX_DUPLICATE_RATIO
    return _verdict(
        counts,
        keys,
        rules,
        *[r.alias(f"{s}_ratio") for s, r in ratio.items()],
        duplicates.alias("duplicate_ratio"),
    )


def media_gate(
    episodes: DataFrame,
    keys: list[str],
    total: str,
    missing: list[str],
    limit: float = MAX_MISSING_MEDIA,
) -> DataFrame:
    """Missing images and depth frames per exported episode."""
    n = F.nullif(F.col(total), F.lit(0))
    rules = {"no_image_rows": count(total) <= 0}
    rules |= {f"{m}_ratio_high": count(m) / n > limit for m in missing}
    return _verdict(episodes, keys, rules, *[(count(m) / n).alias(f"{m}_ratio") for m in missing])


def input_gate(
    present: DataFrame, keys: list[str], stream: str, required: list[str]
) -> DataFrame:
    """Required streams present per episode."""
    seen = present.groupBy(*keys).agg(
        *[F.count_if(F.col(stream) == s).alias(f"_{s}") for s in required]
    )
    return _verdict(seen, keys, {f"missing_{s}": F.col(f"_{s}") == 0 for s in required})


def export_gate(
    wanted: DataFrame, manifest: DataFrame, keys: list[str]
) -> DataFrame:
    """Exactly one manifest row per source episode."""
    rows = manifest.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    joined = wanted.select(*keys).distinct().join(rows, keys, "left")
    return _verdict(
        joined,
        keys,
        {"not_mapped": count("_n") == 0, "mapped_twice": count("_n") > 1},
        count("_n").alias("mappings"),
    )


def passing(rows: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the episodes no gate objects to."""
    return rows.join(verdicts.where(~F.col("ok")).select(*keys), keys, "left_anti")


def dataset_catalog(
    runs: DataFrame, episodes: DataFrame, exports: DataFrame, key: str
) -> DataFrame:
    """One row per run with its episodes, exports and status.

    ``runs``: key, display_name, task_name, updated_at, created_at, status;
    ``episodes``: key, source_episode_index; ``exports``: key, path.
    """
    e = episodes.groupBy(key).agg(
        F.count_distinct("source_episode_index").alias("episode_count"),
        F.max("source_episode_index").alias("latest_source_episode_index"),
    )
    x = exports.groupBy(key).agg(F.count_distinct("path").alias("export_count"))
    zero = F.lit(0).cast("long")
    return (
        runs.join(e, key, "left")
        .join(x, key, "left")
        .select(
            key,
            F.coalesce("display_name", "task_name", F.col(key).cast("string")).alias(
                "display_name"
            ),
            F.coalesce("episode_count", zero).alias("episode_count"),
            "latest_source_episode_index",
            F.coalesce("export_count", zero).alias("export_count"),
            F.coalesce("status", F.lit("idle")).alias("status"),
            F.coalesce("updated_at", "created_at").alias("updated"),
        )
    )
