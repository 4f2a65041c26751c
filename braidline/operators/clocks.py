"""Clock operators: counters, clock models and their application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidline import asof, ordered, session

# Counter width and the limits of a usable clock model.
UINT32 = 1 << 32
MIN_PAIRS = 8
MIN_SPAN_NS = 20_000_000
MIN_SCALE, MAX_SCALE = 0.999, 1.001
ENVELOPE_FRACTION = 0.01
TWO_WAY_MIN_SAMPLES = 8
TWO_WAY_SHARE = 0.20
TWO_WAY_MIN_FIT = 4
TWO_WAY_MIN_SPAN_NS = 2_000_000_000
MAX_LIVE_SKEW_S = 1.5
MAX_ANCHOR_DELTA_MS = 2000.0


def unwrap_counter(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    counter: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add ``unwrapped`` and ``clock_reset`` for a uint32 counter.

    A drop of more than half the range is an overflow, a smaller one a reset.
    Rows without a counter value are passed over.
    """
    pieces = ordered.find_pieces(df, keys, order, rows_per_task)
    stepped = ordered.scan(df, keys, order, pieces=pieces, _prev=ordered.Fill(counter, strict=True))
    drop = F.col("_prev") - F.col(counter)
    marked = stepped.withColumn("_wrap", F.coalesce((drop > UINT32 // 2).cast("long"), F.lit(0)))
    summed = ordered.scan(marked, keys, order, pieces=pieces, _wraps=ordered.RunSum("_wrap"))
    return (
        summed.withColumn("unwrapped", F.col(counter).cast("long") + F.col("_wraps") * F.lit(UINT32))
        .withColumn(
            "clock_reset",
            F.coalesce((drop > 0) & (drop <= UINT32 // 2), F.lit(False)),
        )
        .drop("_prev", "_wrap", "_wraps")
    )


def lower_envelope_fit(
    pairs: DataFrame,
    keys: list[str],
    x_ns: str,
    y_ns: str,
    reset: str | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Affine clock model per source, moved down to the 1st percentile residual.

    One row per source with a usable model. A source with a reset, too few
    pairs, too short a span or an implausible slope has none.
    """
    known = pairs.where(F.col(x_ns).isNotNull() & F.col(y_ns).isNotNull())
    small = ordered.whole_if_small(known, rows_per_task)
    broken = F.max(F.col(reset).cast("int")) if reset else F.lit(0)
    line = (
        known.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("sample_count"),
            (F.max(x_ns) - F.min(x_ns)).alias("_span"),
            F.regr_slope(F.col(y_ns).cast("double"), F.col(x_ns).cast("double")).alias("scale"),
            F.avg(F.col(x_ns).cast("double")).alias("_mx"),
            F.avg(F.col(y_ns).cast("double")).alias("_my"),
            F.coalesce(broken, F.lit(0)).alias("_broken"),
        )
        .where(
            (F.col("_broken") == 0)
            & (F.col("sample_count") >= MIN_PAIRS)
            & (F.col("_span") >= MIN_SPAN_NS)
            & F.col("scale").between(MIN_SCALE, MAX_SCALE)
        )
    )
    offsets = known.join(line.select(*keys, "scale", "_mx", "_my"), keys).withColumn(
        "_r", (F.col(y_ns) - F.col("_my")) - F.col("scale") * (F.col(x_ns) - F.col("_mx"))
    )
    spread = ordered.percentiles(
        offsets, keys, "_r", rows_per_task, small,
        _p1=ENVELOPE_FRACTION, _p50=0.50, _p95=0.95, _p99=0.99, _max=1.0,
    )
    return line.join(spread, keys).select(
        *keys,
        F.lit("affine_lower_envelope").alias("method"),
        "sample_count",
        (F.col("_span") / 1e9).alias("device_span_s"),
        "scale",
        ((F.col("scale") - 1) * 1e6).alias("rate_error_ppm"),
        (F.col("_my") - F.col("scale") * F.col("_mx") + F.col("_p1")).alias("offset_ns"),
        *[
            ((F.col(f"_{p}") - F.col("_p1")) / 1e6).alias(f"residual_{p}_ms")
            for p in ("p50", "p95", "p99", "max")
        ],
    )


def two_way_fit(
    samples: DataFrame,
    keys: list[str],
    phone_ns: str,
    host_ns: str,
    rtt_ns: str,
    seq: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Clock model per session from its lowest round trips.

    The best max(8, 20 %) exchanges give the slope (when there are 4 over 2 s
    and it is plausible, else 1) and the median offset.
    """
    usable = samples.where((F.col(phone_ns) >= 0) & (F.col(host_ns) >= 0) & (F.col(rtt_ns) >= 0))
    small = ordered.whole_if_small(usable, rows_per_task)
    cuts: dict[str, ordered.Pieces] = {}

    def scan(rows: DataFrame, order: list[str], **specs) -> DataFrame:
        # where keys are cut, scans in one order share the places
        if order[0] not in cuts:
            cuts[order[0]] = small or ordered.find_pieces(rows, keys, order, rows_per_task)
        return ordered.scan(rows, keys, order, rows_per_task, cuts[order[0]], **specs)

    def at(rank: str, size: str, fraction: float, value: str) -> dict[str, ordered.Total]:
        """Totals that pick the two values around a fraction of ranked rows."""
        place = (F.col(size) - 1) * F.lit(fraction)
        name = f"_{value.strip('_')}{round(100 * fraction)}"
        return {
            f"{name}_{side}": ordered.Total("max", F.when(F.col(rank) - 1 == end(place), F.col(value)))
            for side, end in (("lo", F.floor), ("hi", F.ceil))
        }

    def between(size: str, fraction: float, value: str) -> Column:
        place = (F.col(size) - 1) * F.lit(fraction)
        share, name = place - F.floor(place), f"_{value.strip('_')}{round(100 * fraction)}"
        return F.col(f"{name}_lo") * (1 - share) + F.col(f"{name}_hi") * share

    # every step is a window over the same keys: where no key is cut, all share one exchange
    order = [rtt_ns, seq]
    ranked = scan(usable, order, _rank=ordered.RowNumber(), _n=ordered.Total("count", rtt_ns))
    quota = F.least(
        F.col("_n"),
        F.greatest(F.lit(TWO_WAY_MIN_SAMPLES), F.ceil(F.col("_n") * F.lit(TWO_WAY_SHARE))),
    )
    trips = ranked.withColumns({"_trip": F.col(rtt_ns), "_quota": quota})
    trips = scan(trips, order, **at("_rank", "_n", 0.50, "_trip"), **at("_rank", "_n", 0.95, "_trip"))
    chosen = trips.where(F.col("_rank") <= F.col("_quota")).withColumns(
        {"_x": F.col(phone_ns).cast("double"), "_y": F.col(host_ns).cast("double")}
    )
    cut = cuts[rtt_ns].table is not None

    def settled(rows: DataFrame) -> DataFrame:
        """Where keys are cut, a step is written, so that the next ones need not compute it anew."""
        return session.materialise(rows.sparkSession, rows, "clock-fit") if cut else rows

    chosen = settled(chosen)
    totals = {"_m": ("count", "_x"), "_sx": ("sum", "_x"), "_sy": ("sum", "_y"),
              "_first": ("min", phone_ns), "_last": ("max", phone_ns)}
    chosen = scan(chosen, order, **{n: ordered.Total(*t) for n, t in totals.items()})
    chosen = chosen.withColumns({"_mx": F.col("_sx") / F.col("_m"), "_my": F.col("_sy") / F.col("_m")})
    chosen = chosen.withColumns({"_dx": F.col("_x") - F.col("_mx"), "_dy": F.col("_y") - F.col("_my")})
    chosen = scan(
        chosen, order,
        _xx=ordered.Total("sum", F.col("_dx") * F.col("_dx")),
        _xy=ordered.Total("sum", F.col("_dx") * F.col("_dy")),
    )
    slope = F.col("_xy") / F.nullif(F.col("_xx"), F.lit(0.0))
    fitted = F.coalesce(
        (F.col("_m") >= TWO_WAY_MIN_FIT)
        & (F.col("_last") - F.col("_first") >= TWO_WAY_MIN_SPAN_NS)
        & slope.between(MIN_SCALE, MAX_SCALE),
        F.lit(False),
    )
    chosen = chosen.withColumn("_fitted", fitted).withColumn("scale", F.when(fitted, slope).otherwise(1.0))
    chosen = settled(chosen.withColumn("_off", F.col("_dy") - F.col("scale") * F.col("_dx")))
    chosen = scan(chosen, ["_off", seq], _orank=ordered.RowNumber())
    chosen = scan(chosen, ["_off", seq], **at("_orank", "_m", 0.50, "_off"))
    chosen = chosen.withColumn("_mid", between("_m", 0.50, "_off"))
    chosen = settled(chosen.withColumn("_res", F.abs(F.col("_off") - F.col("_mid"))))
    chosen = scan(chosen, ["_res", seq], _rrank=ordered.RowNumber())
    wanted = at("_rrank", "_m", 0.50, "_res") | at("_rrank", "_m", 0.95, "_res")
    once = ["_n", "_m", "_first", "_last", "_mx", "_my", "_fitted", "scale", "_mid",
            *at("_rank", "_n", 0.50, "_trip"), *at("_rank", "_n", 0.95, "_trip")]
    one = chosen.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in once], *[F.max(t.value).alias(n) for n, t in wanted.items()]
    )
    return one.select(
        *keys,
        F.when(F.col("_fitted"), F.lit("bidirectional_affine_low_rtt"))
        .otherwise(F.lit("bidirectional_offset"))
        .alias("method"),
        F.col("_n").alias("sample_count"),
        F.col("_m").alias("selected_sample_count"),
        ((F.col("_last") - F.col("_first")) / 1e9).alias("selected_device_span_s"),
        "scale",
        ((F.col("scale") - 1) * 1e6).alias("rate_error_ppm"),
        (F.col("_my") - F.col("scale") * F.col("_mx") + F.col("_mid")).alias("offset_ns"),
        (between("_n", 0.50, "_trip") / 1e6).alias("rtt_p50_ms"),
        (between("_n", 0.95, "_trip") / 1e6).alias("rtt_p95_ms"),
        (between("_m", 0.50, "_res") / 1e6).alias("residual_p50_ms"),
        (between("_m", 0.95, "_res") / 1e6).alias("residual_p95_ms"),
    )


def one_way_offset(frames: DataFrame, keys: list[str], capture: str, receive: str) -> DataFrame:
    """Smallest receive - capture per session. (C4)"""
    return frames.groupBy(*keys).agg(
        F.min(F.col(receive) - F.col(capture)).alias("one_way_offset_ns")
    )


def apply_two_way(
    frames: DataFrame, models: DataFrame, offsets: DataFrame, keys: list[str], capture: str
) -> DataFrame:
    """Map phone times by the session's model, else by its one-way offset.

    The tables hold a few numbers per session; Spark broadcasts them while they
    are small and splits skewed sessions of a sort-merge join when they are not.
    """
    table = offsets.join(models.select(*keys, "method", "scale", "offset_ns"), keys, "left")
    mapped = F.rint(F.col("scale") * F.col(capture) + F.col("offset_ns")).cast("long")
    return (
        frames.join(table, keys)
        .withColumn(
            "aligned_ns", F.coalesce(mapped, F.col(capture) + F.col("one_way_offset_ns"))
        )
        .withColumn("alignment_method", F.coalesce("method", F.lit("one_way_min_delay")))
        .drop("method", "scale", "offset_ns", "one_way_offset_ns")
    )


def apply_envelope(
    samples: DataFrame,
    models: DataFrame,
    keys: list[str],
    x_ns: str,
    receive: str,
    reset: str,
) -> DataFrame:
    """Map device times by the source's model; receive time where there is none."""
    joined = samples.join(models.select(*keys, "scale", "offset_ns"), keys, "left")
    mapped = F.when(
        ~F.col(reset), F.rint(F.col("scale") * F.col(x_ns) + F.col("offset_ns")).cast("long")
    )
    return (
        joined.withColumn("aligned_ns", F.coalesce(mapped, F.col(receive)))
        .withColumn(
            "alignment_method",
            F.when(mapped.isNotNull(), F.lit("device_affine_lower_envelope")).otherwise(
                F.lit("host_receive_fallback")
            ),
        )
        .withColumn("arrival_delay_ms", (F.col(receive) - F.col("aligned_ns")) / 1e6)
        .drop("scale", "offset_ns")
    )


def unix_offset(
    rows: DataFrame, keys: list[str], unix: str, mono: str, rows_per_task: int | None = None
) -> DataFrame:
    """Upper median of unix - monotonic over all rows."""
    return ordered.percentiles(
        rows.withColumn("_d", F.col(unix) - F.col(mono)),
        keys,
        "_d",
        rows_per_task,
        unix_minus_mono_ns="upper_median",
    )


def anchored_offset(
    episodes: DataFrame, anchors: DataFrame, keys: list[str], fallback: DataFrame, run: list[str]
) -> DataFrame:
    """Offset of the episode's own event anchor, else of its run.

    ``anchors`` hold anchor_unix_ns and anchor_mono_ns per episode, ``fallback``
    unix_minus_mono_ns per run.
    """
    own = anchors.select(
        *keys, (F.col("anchor_unix_ns") - F.col("anchor_mono_ns")).alias("_own")
    )
    return (
        episodes.join(own, keys, "left")
        .join(fallback.select(*run, "unix_minus_mono_ns"), run, "left")
        .withColumn("offset_ns", F.coalesce("_own", "unix_minus_mono_ns"))
        .withColumn(
            "offset_source",
            F.when(F.col("_own").isNotNull(), F.lit("episode_event_anchor")).when(
                F.col("unix_minus_mono_ns").isNotNull(), F.lit("run_fallback")
            ),
        )
        .drop("_own", "unix_minus_mono_ns")
    )


def latency_corrected(
    rows: DataFrame, keys: list[str], receive: str, latency: str, rows_per_task: int | None = None
) -> DataFrame:
    """Receive time minus the median latency of the source."""
    middle = ordered.percentiles(rows, keys, latency, rows_per_task, _mid=0.5)
    return (
        rows.join(middle, keys, "left")
        .withColumn("corrected_ns", F.col(receive) - F.col("_mid").cast("long"))
        .drop("_mid")
    )


def rebased(rows: DataFrame, keys: list[str], local: str, epoch: Column) -> DataFrame:
    """Reference epoch plus local time elapsed since the source's first row."""
    first = rows.groupBy(*keys).agg(F.min(local).alias("_first"))
    return (
        rows.join(first, keys)
        .withColumn("rebased_ns", epoch + (F.col(local) - F.col("_first")))
        .drop("_first")
    )


def live_skew(
    rows: DataFrame, keys: list[str], stream: str, first: str, second: str, time: str,
    limit_s: float = MAX_LIVE_SKEW_S,
) -> DataFrame:
    """Distance of the latest samples of two streams and whether it is acceptable."""

    def latest(name):
        return F.max(F.when(F.col(stream) == name, F.col(time)))

    return (
        rows.groupBy(*keys)
        .agg((F.abs(latest(first) - latest(second)) / 1e9).alias("skew_s"))
        .withColumn("skew_ok", F.coalesce(F.col("skew_s") <= limit_s, F.lit(False)))
    )


def match_anchor(
    anchors: DataFrame,
    windows: DataFrame,
    keys: list[str],
    anchor: str,
    anchor_seq: str,
    start: str,
    window_seq: str,
    limit_ms: float = MAX_ANCHOR_DELTA_MS,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Window whose start is nearest to the anchor; refused beyond the limit."""
    joined = asof.nearest_join(
        anchors,
        asof.Stream(windows, start, window_seq),
        keys,
        anchor,
        anchor_seq,
        "window",
        tie="before",
        rows_per_task=rows_per_task,
    )
    delta = F.abs(F.col("window_delta")) / 1e6
    return joined.withColumn("start_delta_ms", delta).withColumn(
        "matched", F.coalesce(delta <= limit_ms, F.lit(False))
    )
