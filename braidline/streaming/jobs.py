"""Live operators that are plain streaming queries: joins, windows, micro-batch jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidline.operators import clocks
from braidline.ordered import floor_div


def event_time(rows: DataFrame, time: str, name: str, delay: str) -> DataFrame:
    """Add the watermarked event time of a nanosecond column."""
    return rows.withColumn(name, F.timestamp_micros(floor_div(F.col(time), 1000))).withWatermark(
        name, delay
    )


def assemble_stream(
    video: DataFrame, metadata: DataFrame, depth: DataFrame, keys: list[str], delay: str
) -> DataFrame:
    """Frames joined with metadata and depth as they arrive, with the rule they break.

    All three streams carry ``keys`` and t, the capture time, which a frame and
    its parts share. Unmatched frames come out once the watermark has passed them.
    """
    v = event_time(video, "t", "_tv", delay).dropDuplicatesWithinWatermark(keys)
    m = event_time(
        metadata.select(*[F.col(k).alias(f"_m_{k}") for k in keys], "t", "depth_expected"),
        "t", "_tm", delay,
    ).drop("t")
    d = event_time(
        depth.select(*[F.col(k).alias(f"_d_{k}") for k in keys], "t"), "t", "_td", delay
    ).drop("t")
    first = keys[0]

    def match(side: str, right: str):
        same = F.col("_tv") == F.col(right)
        for k in keys:
            same = same & (F.col(k) == F.col(f"_{side}_{k}"))
        return same

    joined = v.join(m, match("m", "_tm"), "left_outer").join(d, match("d", "_td"), "left_outer")
    expected = F.coalesce("depth_expected", F.lit(False))
    has_m, has_d = F.col(f"_m_{first}").isNotNull(), F.col(f"_d_{first}").isNotNull()
    rule = (
        F.when(~has_m, F.lit("missing_metadata"))
        .when(expected & ~has_d, F.lit("missing_depth"))
        .when(~expected & has_d, F.lit("unexpected_depth"))
    )
    return joined.select(*video.columns, rule.alias("violation"))


def rate_report(
    packets: DataFrame, keys: list[str], time: str, size: str, window: str, delay: str
) -> DataFrame:
    """Packets, rate and megabits per second in tumbling windows."""
    timed = packets if not packets.isStreaming else event_time(packets, time, "_et", delay)
    if not packets.isStreaming:
        timed = packets.withColumn("_et", F.timestamp_micros(floor_div(F.col(time), 1000)))
    span = F.unix_micros("_w.end") - F.unix_micros("_w.start")
    return (
        timed.groupBy(*keys, F.window("_et", window).alias("_w"))
        .agg(F.count(F.lit(1)).alias("packets"), F.sum(size).alias("bytes"))
        .select(
            *keys,
            (F.unix_micros("_w.start") * 1000).alias("window_start_ns"),
            "packets",
            (F.col("packets") / (span / 1e6)).alias("rate_hz"),
            (F.col("bytes") * 8 / (span / 1e6) / 1e6).alias("mbps"),
        )
    )


def publish_closed(
    spark: SparkSession, publish: Callable[[DataFrame], None], keys: list[str]
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler that publishes the episodes closed in the batch.

    ``keys`` name one episode. ``publish`` gets every closed episode of the batch
    once (keys, start_ns, end_ns) and runs the batch operators for them. Writing
    whole episode partitions, named by the keys, makes a batch that is run again
    after a failure replace its own output.
    """

    def handle(batch: DataFrame, _batch_id: int) -> None:
        closed = batch.select(*keys, "start_ns", "end_ns").distinct()
        publish(closed)

    return handle


def live_clock_mapping(
    spark: SparkSession, keys: list[str], clock_table: str, offset_table: str, output: str
) -> Callable[[DataFrame, int], None]:
    """Micro-batch handler that maps phone times to the host clock.

    A batch holds clock samples (kind "clock": phone_ns, host_ns, rtt_ns) and
    frames (kind "frame": capture_ns, receive_ns), with seq. Samples are added
    to the session's table, from which the model is fitted again; until there
    is one, the smallest offset so far is used. The offset table gets one row
    per session and batch. Each batch writes folders named by its id, so a
    repeated batch overwrites its own rows.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.where(F.col("kind") == "clock").select(
                *keys, "seq", "phone_ns", "host_ns", "rtt_ns"
            ).write.mode("overwrite").parquet(f"{clock_table}/batch={batch_id}")
            frames = batch.where(F.col("kind") == "frame").select(
                *keys, "seq", "capture_ns", "receive_ns"
            )
            clocks.one_way_offset(frames, keys, "capture_ns", "receive_ns").write.mode(
                "overwrite"
            ).parquet(f"{offset_table}/batch={batch_id}")
            samples = spark.read.option("basePath", clock_table).parquet(clock_table)
            past = spark.read.option("basePath", offset_table).parquet(offset_table)
            # a batch that is run again must not see later ones
            samples = samples.where(F.col("batch") <= batch_id)
            past = past.where(F.col("batch") <= batch_id)
            offsets = past.groupBy(*keys).agg(F.min("one_way_offset_ns").alias("one_way_offset_ns"))
            models = clocks.two_way_fit(samples, keys, "phone_ns", "host_ns", "rtt_ns", "seq")
            mapped = clocks.apply_two_way(frames, models, offsets, keys, "capture_ns")
            status = F.when(
                F.col("alignment_method") == "one_way_min_delay", F.lit("estimating")
            ).otherwise(F.lit("receiver_aligned"))
            mapped.withColumn("status", status).write.mode("overwrite").parquet(
                f"{output}/batch={batch_id}"
            )
        finally:
            batch.unpersist()

    return handle
