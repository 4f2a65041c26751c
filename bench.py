"""Time the headline queries and print one JSON line.

Every query runs once to warm up and then three times; the median counts.
Results go to Spark's noop sink, so all columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from braidline import session  # noqa: E402
from braidline.queries import load  # noqa: E402
from braidline.queries.base import REGISTRY, Tables  # noqa: E402

HEADLINE = [
    "align_timeline",
    "align_timeline_cut_keys",
    "j1_nearest",
    "j5_clamped_interpolation",
    "j9_samples_in_windows",
    "j10_fused_sensors",
    "c1_unwrap_counter",
    "c2_lower_envelope_fit",
    "c3_two_way_fit",
    "e1_pair_start_stop",
    "e9_effective_end",
    "f10_jump_filter",
    "w1_pose_actions",
    "w4_moving_average",
    "w8_exponential_smoothing",
    "a2_source_reuse",
    "a4_frame_integrity",
    "a7_percentiles",
    "a37_max_force",
    "x17_wrench_table",
    "m1_calibrated_wrench",
    "k3_aligned_index",
    "k5_flat_training_table",
]


def timed(build, tables: Tables) -> float:
    start = time.perf_counter()
    build(tables).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session.local_session("bench", cpus)
    load()
    tables = Tables(spark, folder)
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        build = REGISTRY[name].build
        timed(build, tables)
        seconds[name] = round(statistics.median(timed(build, tables) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
