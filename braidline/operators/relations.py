"""Equi joins between streams: frames, metadata, depth, events, clock exchanges, catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import asof, ordered


def frames_with_metadata(
    frames: DataFrame, metadata: DataFrame, keys: list[str], capture: str = "capture_ns"
) -> tuple[DataFrame, DataFrame]:
    """One metadata row per frame, both ways.

    Both sides carry ``capture``. Returns the matched rows, and one row per
    violation: a frame without metadata, metadata without a frame, or a pair
    that disagrees about the capture time.
    """
    right = metadata.withColumnRenamed(capture, "_meta_ns").withColumn("_m", F.lit(True))
    both = frames.withColumn("_f", F.lit(True)).join(right, keys, "full")
    rule = (
        F.when(F.col("_m").isNull(), F.lit("missing_metadata"))
        .when(F.col("_f").isNull(), F.lit("missing_frame"))
        .when(~F.col(capture).eqNullSafe(F.col("_meta_ns")), F.lit("timestamp_mismatch"))
    )
    judged = both.withColumn("violation", rule)
    matched = judged.where(F.col("violation").isNull()).drop("_m", "_f", "_meta_ns", "violation")
    return matched, judged.where(F.col("violation").isNotNull()).select(*keys, "violation")


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row per key in ``order``.

    A maximum over structs is combined map-side, so a key with many copies
    costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def with_optional(
    left: DataFrame, right: DataFrame, keys: list[str], order: list[str], flag: str
) -> DataFrame:
    """Left join with the last duplicate of the right side; ``flag`` says if there is one."""
    one = latest_by(right, keys, order).withColumn(flag, F.lit(True))
    return left.join(one, keys, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def events_with_timing(events: DataFrame, timing: DataFrame, keys: list[str]) -> DataFrame:
    """Events with the timing of their frame; only frames that carry one are read."""
    return events.join(timing, keys)


def fused_sensors(
    left: asof.Stream,
    right: asof.Stream,
    keys: list[str],
    values: list[str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Average of two sensors on the times of the shorter one.

    The shorter stream is found per key (the left one when equal); both streams
    are interpolated at its times, clamped at the ends.
    """
    names = [*keys, "_at", "_seq", *values]

    def shaped(s: asof.Stream, side: str) -> DataFrame:
        return s.df.select(
            *keys, F.col(s.time).alias("_at"), F.col(s.seq).alias("_seq"), *values
        ).withColumn("_side", F.lit(side))

    lf, rf = shaped(left, "left"), shaped(right, "right")
    shorter = (
        lf.select(*keys, "_side")
        .unionByName(rf.select(*keys, "_side"))
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("_side") == "left").alias("_nl"),
            F.count_if(F.col("_side") == "right").alias("_nr"),
        )
        .where((F.col("_nl") > 0) & (F.col("_nr") > 0))
        .select(
            *keys,
            F.when(F.col("_nl") <= F.col("_nr"), F.lit("left"))
            .otherwise(F.lit("right"))
            .alias("_side"),
        )
    )
    times = lf.unionByName(rf).join(shorter, [*keys, "_side"], "left_semi").select(*keys, "_at", "_seq")
    both = asof.bracket_join(
        times,
        {
            "l": asof.Stream(lf.select(*names).withColumnRenamed("_at", "_time"), "_time", "_seq"),
            "r": asof.Stream(rf.select(*names).withColumnRenamed("_at", "_time"), "_time", "_seq"),
        },
        keys, "_at", "_seq", rows_per_task,
    )
    staged = both
    for s in ("l", "r"):
        before, after = asof.bracket(s, "_at")
        staged = staged.withColumn(f"_{s}lo", F.coalesce(before, after)).withColumn(
            f"_{s}hi", F.coalesce(after, before)
        )

    def at(s: str, v: str) -> Column:
        lo, hi = F.col(f"_{s}lo"), F.col(f"_{s}hi")
        return asof.lerp(lo[v], hi[v], asof.alpha(lo, hi, F.col("_at")))

    return staged.select(
        *keys,
        F.col("_at").alias("t"),
        F.col("_seq").alias("seq"),
        *[((at("l", v) + at("r", v)) * 0.5).alias(v) for v in values],
    )


def preferred_samples(
    timeline: DataFrame, raw: DataFrame, keys: list[str]
) -> DataFrame:
    """Rows of the aligned timeline; raw samples only for episodes that have none.

    Both inputs hold usable rows with the same columns.
    """
    covered = timeline.select(*keys).distinct()
    return timeline.withColumn("source", F.lit("timeline")).unionByName(
        raw.join(covered, keys, "left_anti").withColumn("source", F.lit("raw"))
    )


def with_parameters(rows: DataFrame, parameters: DataFrame, keys: list[str]) -> DataFrame:
    """Sensor rows with the model parameters of their side.

    Parameters are a few vectors per side; their number is left to Spark to
    check before it broadcasts them.
    """
    return rows.join(parameters, keys)


def clock_exchanges(
    requests: DataFrame, responses: DataFrame, keys: list[str], sent: str = "t1_ns"
) -> tuple[DataFrame, DataFrame]:
    """Responses with the request they answer.

    Returns the valid exchanges, and responses whose id is unknown or whose
    send time was changed.
    """
    asked = requests.select(*keys, F.col(sent).alias("_sent"))
    joined = responses.join(asked, keys, "left").withColumn(
        "violation",
        F.when(F.col("_sent").isNull(), F.lit("unknown_request_id")).when(
            F.col("_sent") != F.col(sent), F.lit("changed_send_time")
        ),
    )
    good = joined.where(F.col("violation").isNull()).drop("_sent", "violation")
    return good, joined.where(F.col("violation").isNotNull()).select(*keys, "violation")


def assemble_frames(
    video: DataFrame, metadata: DataFrame, depth: DataFrame, events: DataFrame, keys: list[str]
) -> DataFrame:
    """Video frames with metadata, depth and event count, and the rule they break.

    Metadata (with ``depth_expected``) is required; depth is required exactly
    when it is expected.
    """
    m = metadata.withColumn("_m", F.lit(True))
    d = depth.withColumn("_d", F.lit(True))
    e = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("event_count"))
    joined = video.join(m, keys, "left").join(d, keys, "left").join(e, keys, "left")
    expected = F.coalesce("depth_expected", F.lit(False))
    rule = (
        F.when(F.col("_m").isNull(), F.lit("missing_metadata"))
        .when(expected & F.col("_d").isNull(), F.lit("missing_depth"))
        .when(~expected & F.col("_d").isNotNull(), F.lit("unexpected_depth"))
    )
    return (
        joined.withColumn("violation", rule)
        .withColumn("event_count", F.coalesce("event_count", F.lit(0).cast("long")))
        .drop("_m", "_d")
    )


def pulse_means(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    level: str,
    values: list[str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Mean of every run of equal ``level``, numbered from 0."""
    pieces = ordered.find_pieces(rows, keys, order, rows_per_task)
    changed = ordered.scan(rows, keys, order, pieces=pieces, _prev=ordered.Lag(level)).withColumn(
        "_edge", F.coalesce((F.col("_prev") != F.col(level)).cast("long"), F.lit(0))
    )
    numbered = ordered.scan(changed, keys, order, pieces=pieces, segment=ordered.RunSum("_edge"))
    return numbered.groupBy(*keys, "segment").agg(*[F.avg(v).alias(v) for v in values])


def paired_pulses(
    first: DataFrame, second: DataFrame, keys: list[str], values: list[str]
) -> DataFrame:
    """The i-th pulse of one sensor with the i-th of another, both cut at the ends.

    The first pulse of each is partial and the next one noisy, and the last of
    the shorter recording is not trusted: all three are left out.
    """
    a = first.select(*keys, "segment", *[F.col(v).alias(f"a_{v}") for v in values])
    b = second.select(*keys, "segment", *[F.col(v).alias(f"b_{v}") for v in values])
    last = (
        first.groupBy(*keys)
        .agg(F.max("segment").alias("_a"))
        .join(second.groupBy(*keys).agg(F.max("segment").alias("_b")), keys)
        .select(*keys, F.least("_a", "_b").alias("_last"))
    )
    return (
        a.join(b, [*keys, "segment"])
        .join(last, keys)
        .where((F.col("segment") >= 2) & (F.col("segment") < F.col("_last")))
        .drop("_last")
    )


def conflicting_payloads(packets: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """Keys that arrived with different payloads."""
    return (
        packets.groupBy(*keys)
        .agg(F.count_distinct(F.md5(F.col(payload).cast("binary"))).alias("variants"))
        .where(F.col("variants") > 1)
    )


def episode_catalog(
    logical: DataFrame, manifest: DataFrame, key: str, attributes: list[str]
) -> DataFrame:
    """Logical episodes with the manifest's attributes, their own as defaults."""
    own = manifest.select(key, *[F.col(a).alias(f"_m_{a}") for a in attributes])
    joined = logical.join(own, key, "left")
    cols = [
        F.coalesce(f"_m_{c}", c).alias(c) if c in attributes else F.col(c)
        for c in logical.columns
    ]
    return joined.select(*cols)
