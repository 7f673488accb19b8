"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names), BENCH_RUNS (default 3): one warm-up, then
the median. Every column of every row is computed (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from silvagrid.plans.staging import clear_staged  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "forest_extract",
    "forest_extract_tiles",
    "forest_per_scene",
    "pixels_to_tiles",
    "percentile_stretch",
    "hist_match",
    "composite_median",
    "composite_priority",
    "seam_bias",
    "focal_mean",
    "focal_std",
    "focal_median",
    "convolve",
    "lbp",
    "glcm_features",
    "threshold_otsu",
    "morph_open",
    "connected_components",
    "region_stats",
    "points_in_polygon",
    "zonal_cube",
    "transition_matrix",
    "pixel_series",
    "asof_scene",
    "stratified_sample",
    "threshold_sweep",
    "tile_map_halo",
    "stream_tumbling",
]


def session(cpus: str, ui: str = "false") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        # small test tables: keep all cores busy instead of merging to 1 MB partitions
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "32k")
        .config("spark.ui.enabled", ui)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    clear_staged(spark)
    line = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
