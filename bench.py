"""Headline queries on ``$BENCH_SF_DIR``; prints one JSON line.

Every query is planned and run to the end with its result discarded by the
no-op sink, once to warm up and then timed (best of ``$BENCH_REPS``).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ndvi4",
    "ndvi_classes",
    "pixels_to_tiles",
    "assemble_scenes",
    "tile_to_layout",
    "zscore_trunc",
    "window_tile_join",
    "stitch_windows",
    "generate_samples",
    "mask_polygon",
    "mask_polygon_tiles",
    "polygon_zones",
    "extract_polygon",
    "pyramid_level",
    "with_index",
    "reproject_nn",
]


def session():
    from pyspark.sql import SparkSession

    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rastertable-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from rastertable import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    reps = int(os.environ.get("BENCH_REPS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    queries = catalog.queries()
    spark = session()
    times = {}
    for name in names:
        best = None
        for rep in range(reps + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if rep and (best is None or took < best):
                best = took
        times[name] = round(best, 3)
        print(f"{name}: {best:.2f}s", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
