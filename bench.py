"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is run once to warm up and then timed twice into the noop sink; the
faster time counts.
"""

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_points",
    "voxelize",
    "majority_label",
    "voxel_features",
    "profile_points",
    "high_intensity",
    "distinct_voxels",
    "json_messages",
    "json_roundtrip",
    "partitioned_table",
    "stream_clean",
    "ply_scan",
    "label_overlay",
    "class_report",
    "version_current",
    "version_log",
    "counter_rate",
    "cpu_usage",
    "latest_gauge",
    "scale_features",
    "scale_features_train",
    "ply_scan_ascii",
    "version_replace",
    "version_as_of_saved",
    "append_table",
    "compact",
    "classify_voxels",
]


def main() -> None:
    from pointmill.plans.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(min(run(name), run(name)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
