"""The study's jobs as one command line.

    python -m ridelens <job> --trips PATH --zones PATH [--format csv] [--zones-format csv]
                       [--out DIR] [--conf key=value ...] [--unique-zones]

Jobs: ``merge``, ``aggregate``, ``top``, ``averages``, ``anomalies``,
``filtering``, ``routes`` (one per original job). Each prints its results
the way the original does (a preview per question), and ``aggregate`` and
``anomalies`` also write their header-CSV exports under ``--out``. Object
store access comes from the environment variables ``S3_ENDPOINT``,
``S3_ACCESS_KEY`` and ``S3_SECRET_KEY``, or from a file of ``key=value`` lines
given as ``--conf-file``; keys on the command line would show in the process
list, so ``--conf`` refuses them.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelens.operators.filters import between_places
from ridelens.operators.zone_merge import enrich, prepare_lookup
from ridelens.plans import analyses as A
from ridelens.plans import series as S
from ridelens.session import build_session, store_conf_from_environment
from ridelens.sources.readers import read_trips, read_zones
from ridelens.sources.sinks import export_csv


def _merge(spark: SparkSession, args) -> None:
    merged = args.merged
    merged.show(5)
    print(f"{A.row_count(merged).first()[0]} merged trips")
    merged.printSchema()


@contextmanager
def _kept(df: DataFrame):
    """A small result, computed once for the several tables made of it."""
    df.cache()
    try:
        yield df
    finally:
        df.unpersist()


def _aggregate(spark: SparkSession, args) -> None:
    # One aggregate for the three published tables.
    with _kept(S.business_month_totals(args.merged)) as series:
        outputs = {
            "trip_count": ["business_month", "trip_count"],
            "total_profit": ["business_month", "total_profit"],
            "total_earnings": ["business_month", "total_earnings"],
        }
        for cols in outputs.values():
            series.select(*cols).show()
        if args.out:
            for name, cols in outputs.items():
                export_csv(series.select(*cols), f"{args.out}/{name}")


def _top(spark: SparkSession, args) -> None:
    A.top_pickup_boroughs(args.merged).show(100)
    A.top_dropoff_boroughs(args.merged).show(100)
    A.top_borough_routes(args.merged).show(30, truncate=False)


def _averages(spark: SparkSession, args) -> None:
    with _kept(A.time_of_day_averages(args.merged)) as both:
        for name in ("average_driver_total_pay", "average_trip_length"):
            both.select("time_of_day", name).orderBy(F.desc(name)).show()
        ratio = "average_earning_per_mile"
        both.where("time_of_day IS NOT NULL").select("time_of_day", ratio).orderBy(F.desc(ratio)).show()


def _anomalies(spark: SparkSession, args) -> None:
    with _kept(A.daily_wait(args.merged, args.month)) as daily:
        daily.orderBy("day").show(31)
        A.long_wait_days(daily, args.threshold).orderBy("day").show()
        if args.out:
            export_csv(daily, args.out, order_by=["day"])


def _filtering(spark: SparkSession, args) -> None:
    with _kept(A.filter_counts(args.merged)) as counts:
        slots = counts.groupBy("Pickup_Borough", "time_of_day").agg(F.sum("trip_count").alias("trip_count"))
        between = (F.col("trip_count") > A.SLOT_COUNT_LOWER) & (F.col("trip_count") < A.SLOT_COUNT_UPPER)
        slots.where(between).show(truncate=False)
        evening = slots.where(F.col("time_of_day") == A.EVENING)
        evening.select("Pickup_Borough", "time_of_day", "trip_count").show(truncate=False)
        pair = between_places(counts, args.pickup, args.dropoff)
        count = pair.agg(F.coalesce(F.sum("trip_count"), F.lit(0))).first()[0]
    A.borough_pair_sample(args.merged, args.pickup, args.dropoff).show(10, truncate=False)
    print(f"{count} trips, {args.pickup} -> {args.dropoff}")


def _routes(spark: SparkSession, args) -> None:
    A.top_zone_routes(args.merged).show(truncate=False)


JOBS: dict[str, Callable[[SparkSession, argparse.Namespace], None]] = {
    "merge": _merge,
    "aggregate": _aggregate,
    "top": _top,
    "averages": _averages,
    "anomalies": _anomalies,
    "filtering": _filtering,
    "routes": _routes,
}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ridelens", description="Trip analyses on Spark.")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--trips", required=True, help="trip table path or URI")
    p.add_argument("--zones", required=True, help="zone lookup path or URI")
    p.add_argument("--format", default="csv", help="input format of the trips (default csv)")
    p.add_argument("--zones-format", help="input format of the zone lookup (default: --format)")
    p.add_argument("--out", help="output folder for jobs that export CSV")
    p.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="extra session conf")
    p.add_argument("--conf-file", help="file of KEY=VALUE lines with session conf (secrets go here or in the environment)")
    p.add_argument("--unique-zones", action="store_true", help="keep one lookup row per zone id")
    p.add_argument("--month", type=int, default=A.WAIT_MONTH)
    p.add_argument("--threshold", type=float, default=A.WAIT_THRESHOLD_SECONDS)
    p.add_argument("--pickup", default=A.PAIR_PICKUP)
    p.add_argument("--dropoff", default=A.PAIR_DROPOFF)
    args = p.parse_args(argv)
    bad = [item for item in args.conf if "=" not in item]
    if bad:
        p.error(f"--conf takes KEY=VALUE, got: {', '.join(bad)}")
    secret = [key for key, _, _ in (item.partition("=") for item in args.conf) if key.lower().endswith((".access.key", ".secret.key"))]
    if secret:
        p.error(f"not on the command line: {', '.join(secret)} (use the environment or --conf-file)")
    return args


def session_conf(args: argparse.Namespace, env: Mapping[str, str]) -> dict[str, str]:
    """The session conf of a job: the environment's object store, then the conf
    file, then ``--conf``; later ones win."""
    conf = store_conf_from_environment(env)
    lines: list[str] = []
    if args.conf_file:
        with open(args.conf_file) as fh:
            lines = [line.strip() for line in fh]
    for item in [x for x in lines if x and not x.startswith("#")] + args.conf:
        key, _, value = item.partition("=")
        conf[key.strip()] = value.strip()
    return conf


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    """Run one job on an existing session."""
    trips = read_trips(spark, args.trips, fmt=args.format)
    zones = prepare_lookup(read_zones(spark, args.zones, fmt=args.zones_format or args.format))
    args.merged = enrich(trips, zones, unique_zones=args.unique_zones)
    JOBS[args.job](spark, args)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    spark = build_session(app_name=f"ridelens-{args.job}", extra_conf=session_conf(args, os.environ))
    try:
        run(spark, args)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
