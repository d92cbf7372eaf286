"""Benchmark the analyses.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 3). Each query is planned and run once
to warm up, then timed ``BENCH_RUNS`` times into the no-op sink (every row is
produced, nothing is collected); the median is reported. The one-off cost of
writing the trip table from the star tables is reported as ``prepare_trips``
and is not part of the headline value, which is the sum of the analysis
medians; ``value_plans_built_anew`` is the sum over one run of each with no
plan kept from before. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ridelens.plans.registry import QUERIES  # noqa: E402
from ridelens.session import PINNED_SQL_CONF  # noqa: E402
from ridelens.sources import star  # noqa: E402
from ridelens.sources.star import materialize_trips  # noqa: E402

# that replaces the three monthly aggregates. The extra keys are timed but not summed.
HEADLINE = [
    "merge_zones", "merged_row_count", "monthly_trips", "monthly_profit", "monthly_earnings",
    "top_pickup_boroughs", "top_dropoff_boroughs", "top_pickup_zones", "top_dropoff_zones",
    "top_borough_routes", "avg_pay_by_tod", "avg_length_by_tod", "earning_per_mile", "daily_wait",
    "long_wait_days", "rare_pickup_slots", "evening_pickups", "borough_pair_count", "top_zone_routes",
    "merge_zones_unique", "monthly_trips_unique",
]
EXTRA = ["business_month_series", "join_two_aggregates", "scan_csv_header", "sink_csv_roundtrip", "merge_zones_shuffled", "merge_zones_typed_shuffled"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="ridelens-bench-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ridelens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(max(cpus * 2, 8)))
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
    )
    for k, v in PINNED_SQL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(scratch)

    t0 = time.perf_counter()
    materialize_trips(spark, sf_dir)
    prepare = time.perf_counter() - t0

    timings: dict[str, float] = {}
    for name in HEADLINE + EXTRA:
        query = QUERIES[name]
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        samples = []
        for _ in range(runs):
            t = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(samples), 4)

    # The plans above are kept per session; here every one is built anew, as a first call does.
    fresh = 0.0
    for name in HEADLINE:
        star._FRAMES.clear()
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        fresh += time.perf_counter() - t

    total = round(sum(timings[k] for k in HEADLINE), 4)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    out = {
        "metric": "sum_median_sec_analyses",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "prepare_trips": round(prepare, 4),
        "value_plans_built_anew": round(fresh, 4),
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
