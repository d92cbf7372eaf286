"""Keyed queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query loads the trip and zone views of ``sf_dir``, merges them and runs
one analysis or operator over the whole table. Doubles are rounded here, in
the reporting layer, so results compare across engines whose float addition
order differs: money to 2 places, averages, ratios and logs to 6.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ridelens.functions.dates import day_of, epoch_to_date, month_of, year_of
from ridelens.functions.keys import borough_route, zone_route
from ridelens.operators.aggregate import count_by
from ridelens.operators.rank import rank_within
from ridelens.operators.zone_merge import enrich
from ridelens.plans import analyses as A
from ridelens.plans import series as S
from ridelens.session import pin_session, scratch_dir
from ridelens.sources.readers import read_trips
from ridelens.sources.sinks import export_csv
from ridelens.sources.star import cached_for, load_inputs, load_prepared

Query = Callable[[SparkSession, str], DataFrame]

# The borough pair used on the test tables (the study's own
# pair, Brooklyn to Staten Island, has no rows there).
TEST_PAIR = ("ASIA", "EUROPE")
MONEY_PLACES = 2
RATIO_PLACES = 6
STREAM_FILES_PER_TRIGGER = 4
DOUBLED_ZONE_ID = "3"
#: Small enough that the test tables' ids are dealt over several salts.
SHUFFLED_ROWS_PER_TASK = 500


def _round(df: DataFrame, places: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c), places[c]).alias(c) if c in places else F.col(c) for c in df.columns])


def _merged(spark: SparkSession, sf_dir: str, unique_zones: bool = False) -> DataFrame:
    """The merged trip table of ``sf_dir``: a plan, built once per session."""
    pin_session(spark)
    trips, lookup = load_prepared(spark, sf_dir)
    build = lambda: enrich(trips, lookup, unique_zones=unique_zones)
    return cached_for(spark, sf_dir, f"merged-{unique_zones}", build)


def _doubled_lookup(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The trips, and the zone lookup with ``DOUBLED_ZONE_ID`` listed twice."""
    pin_session(spark)
    trips, zones = load_inputs(spark, sf_dir)
    again = zones.where(F.col("LocationID") == DOUBLED_ZONE_ID).withColumn("Zone", F.concat("Zone", F.lit(" 2")))
    return trips, zones.unionByName(again)


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    return load_inputs(spark, sf_dir)[0]


# Sources and sinks -----------------------------------------------------------

def scan_csv_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written as header CSV to the scratch folder, read back by name."""
    path = f"{scratch_dir(spark)}/trips-csv-{uuid.uuid4().hex}"
    _trips(spark, sf_dir).write.option("header", "true").csv(path)
    return read_trips(spark, path, fmt="csv")


SERIES_SCHEMA = StructType(
    [
        StructField("business_month", StringType()),
        StructField("trip_count", LongType()),
        StructField("total_profit", DoubleType()),
        StructField("total_earnings", DoubleType()),
    ]
)


def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business-month series exported as one header CSV file and read
    back with its schema."""
    path = f"{scratch_dir(spark)}/series-csv-{uuid.uuid4().hex}"
    export_csv(S.business_month_totals(_merged(spark, sf_dir)), path, order_by=["business_month"])
    back = spark.read.option("header", "true").schema(SERIES_SCHEMA).csv(path)
    return _round(back, {"total_profit": MONEY_PLACES, "total_earnings": MONEY_PLACES})


def sink_csv_part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files and rows of the series' export: one file by contract."""
    path = f"{scratch_dir(spark)}/series-csv-{uuid.uuid4().hex}"
    export_csv(S.business_month_totals(_merged(spark, sf_dir)), path, order_by=["business_month"])
    back = spark.read.option("header", "true").csv(path).withColumn("file", F.input_file_name())
    return back.agg(F.count_distinct("file").alias("part_files"), F.count(F.lit(1)).alias("row_count"))


def stream_business_month_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The business-month series computed by a streaming query: the trips are
    dropped as header CSV files into a folder, read a few files per trigger,
    merged with the static lookup, aggregated with state and written as a
    complete version of the table after each trigger; the last one is
    returned."""
    from ridelens.streaming.files import business_month_totals_stream, read_table, read_trip_stream, run_to_table

    pin_session(spark)
    trips, lookup = load_prepared(spark, sf_dir)
    run = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    trips.write.option("header", "true").csv(f"{run}/incoming")
    stream = read_trip_stream(spark, f"{run}/incoming", max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    run_to_table(business_month_totals_stream(stream, lookup), f"{run}/table", f"{run}/checkpoint")
    back = read_table(spark, f"{run}/table")
    return _round(back, {"total_profit": MONEY_PLACES, "total_earnings": MONEY_PLACES})


# Scalar functions and keys ---------------------------------------------------

def q_epoch_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _trips(spark, sf_dir)
    return count_by(trips, epoch_to_date("date").alias("date"), "trip_count")


def q_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merged(spark, sf_dir)
    keys = [year_of("date").alias("year"), month_of("date").alias("month"), day_of("date").alias("day")]
    return count_by(merged, keys, "trip_count")


def q_month_of_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(_merged(spark, sf_dir), month_of("date").alias("Month"), "trip_count")


def q_business_month_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = A.with_date_parts(_merged(spark, sf_dir))
    return count_by(parts, ["business", "month", "business_month"], "trip_count")


def q_borough_route_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merged(spark, sf_dir)
    route = borough_route("Pickup_Borough", "Dropoff_Borough").alias("Route")
    return count_by(merged, ["Pickup_Borough", "Dropoff_Borough", route], "trip_count")


def q_zone_route_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _merged(spark, sf_dir)
    route = zone_route("Pickup_Zone", "Dropoff_Zone").alias("Route")
    return count_by(merged, ["Pickup_Zone", "Dropoff_Zone", route], "trip_count")


# Grouping, ranking, joins ----------------------------------------------------

def q_pickup_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(_merged(spark, sf_dir), ["Pickup_Borough", month_of("date").alias("Month")], "trip_count")


def q_dropoff_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(_merged(spark, sf_dir), ["Dropoff_Borough", month_of("date").alias("Month")], "trip_count")


def q_rank_boroughs_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = q_pickup_month_counts(spark, sf_dir)
    return rank_within(counts, "Month", "trip_count", "rank")


def q_route_counts_by_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.route_counts_by_business(_merged(spark, sf_dir))


def q_join_two_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.join_two_aggregates(_merged(spark, sf_dir))
    return _round(out, {c: RATIO_PLACES for c in out.columns if c != "time_of_day"})


def q_borough_pair_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.borough_pair_trips(_merged(spark, sf_dir), *TEST_PAIR)


def q_borough_pair_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.borough_pair_sample(_merged(spark, sf_dir), *TEST_PAIR)


# Series ------------------------------------------------------------------------

def q_business_month_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.business_month_series(_merged(spark, sf_dir))
    return _round(out, {"total_profit": MONEY_PLACES, "total_earnings": MONEY_PLACES})


def q_business_month_log_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.business_month_log_series(_merged(spark, sf_dir))
    return _round(out, {c: RATIO_PLACES for c in out.columns if c.startswith("log_")})


def q_wait_series_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.wait_series_flagged(_merged(spark, sf_dir))
    return _round(out, {"average_waiting_time": RATIO_PLACES})


# Analyses ----------------------------------------------------------------------

def q_merge_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir)


def q_merged_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.row_count(_merged(spark, sf_dir), "row_count")


def q_monthly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.monthly_trips(_merged(spark, sf_dir))


def q_monthly_profit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(A.monthly_profit(_merged(spark, sf_dir)), {"total_profit": MONEY_PLACES})


def q_monthly_earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(A.monthly_earnings(_merged(spark, sf_dir)), {"total_earnings": MONEY_PLACES})


def q_top_pickup_boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_pickup_boroughs(_merged(spark, sf_dir))


def q_top_dropoff_boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_dropoff_boroughs(_merged(spark, sf_dir))


def q_top_pickup_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_places_per_month(_merged(spark, sf_dir), "Pickup_Zone")


def q_top_dropoff_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_places_per_month(_merged(spark, sf_dir), "Dropoff_Zone")


def q_top_borough_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(A.top_borough_routes(_merged(spark, sf_dir)), {"total_profit": MONEY_PLACES})


def q_avg_pay_by_tod(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.avg_pay_by_time_of_day(_merged(spark, sf_dir))
    return _round(out, {"average_driver_total_pay": RATIO_PLACES})


def q_avg_length_by_tod(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.avg_length_by_time_of_day(_merged(spark, sf_dir))
    return _round(out, {"average_trip_length": RATIO_PLACES})


def q_earning_per_mile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.earning_per_mile(_merged(spark, sf_dir))
    return _round(out, {"average_earning_per_mile": RATIO_PLACES})


def q_daily_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(A.daily_wait(_merged(spark, sf_dir)), {"average_waiting_time": RATIO_PLACES})


def q_long_wait_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.long_wait_days(A.daily_wait(_merged(spark, sf_dir)))
    return _round(out, {"average_waiting_time": RATIO_PLACES})


def q_rare_pickup_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.rare_pickup_slots(_merged(spark, sf_dir))


def q_evening_pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.pickups_at_time(_merged(spark, sf_dir))


def q_borough_pair_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.borough_pair_count(_merged(spark, sf_dir), *TEST_PAIR)


def q_top_zone_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.top_zone_routes(_merged(spark, sf_dir))


def q_merge_zones_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, unique_zones=True)


def q_merge_zones_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(*_doubled_lookup(spark, sf_dir))


def q_merge_zones_fanout_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(*_doubled_lookup(spark, sf_dir), unique_zones=True)


def q_merge_zones_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge as a lookup beyond the broadcast bound gets it."""
    trips, zones = _doubled_lookup(spark, sf_dir)
    return enrich(trips, zones, broadcast_max_rows=1, rows_per_salt_task=SHUFFLED_ROWS_PER_TASK)


def _typed_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A typed parquet copy of the trips, numbers as numbers, and a lookup with
    numeric ids (so an id matches by its text)."""
    pin_session(spark)
    trips, zones = load_inputs(spark, sf_dir)
    typed = trips.select(
        "business", F.col("pickup_location").cast("int").alias("pickup_location"), F.col("dropoff_location").cast("int").alias("dropoff_location"),
        F.col("trip_length").cast("double").alias("trip_length"), F.col("request_to_pickup").cast("int").alias("request_to_pickup"),
        F.col("date").cast("bigint").alias("Date"), "time_of_day", F.col("driver_total_pay").cast("double").alias("driver_pay"),
    )
    path = f"{scratch_dir(spark)}/trips-typed-{uuid.uuid4().hex}"
    typed.write.parquet(path)
    return spark.read.schema(typed.schema).parquet(path), zones.withColumn("LocationID", F.col("LocationID").cast("bigint"))


def q_merge_zones_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of typed trips."""
    return enrich(*_typed_inputs(spark, sf_dir))


def q_merge_zones_typed_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge of typed trips with a lookup beyond the broadcast bound."""
    return enrich(*_typed_inputs(spark, sf_dir), broadcast_max_rows=1, rows_per_salt_task=SHUFFLED_ROWS_PER_TASK)


def q_monthly_trips_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.monthly_trips(_merged(spark, sf_dir, unique_zones=True))


QUERIES: dict[str, Query] = {
    # operators
    "scan_csv_header": scan_csv_header,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "sink_csv_part_files": sink_csv_part_files,
    "epoch_to_date": q_epoch_to_date,
    "date_parts": q_date_parts,
    "month_of_date": q_month_of_date,
    "business_month_key": q_business_month_key,
    "borough_route_key": q_borough_route_key,
    "zone_route_key": q_zone_route_key,
    "pickup_month_counts": q_pickup_month_counts,
    "dropoff_month_counts": q_dropoff_month_counts,
    "rank_boroughs_by_month": q_rank_boroughs_by_month,
    "route_counts_by_business": q_route_counts_by_business,
    "join_two_aggregates": q_join_two_aggregates,
    "borough_pair_trips": q_borough_pair_trips,
    "borough_pair_sample": q_borough_pair_sample,
    "business_month_series": q_business_month_series,
    "stream_business_month_series": stream_business_month_series,
    "business_month_log_series": q_business_month_log_series,
    "wait_series_flagged": q_wait_series_flagged,
    # analyses
    "merge_zones": q_merge_zones,
    "merged_row_count": q_merged_row_count,
    "monthly_trips": q_monthly_trips,
    "monthly_profit": q_monthly_profit,
    "monthly_earnings": q_monthly_earnings,
    "top_pickup_boroughs": q_top_pickup_boroughs,
    "top_dropoff_boroughs": q_top_dropoff_boroughs,
    "top_pickup_zones": q_top_pickup_zones,
    "top_dropoff_zones": q_top_dropoff_zones,
    "top_borough_routes": q_top_borough_routes,
    "avg_pay_by_tod": q_avg_pay_by_tod,
    "avg_length_by_tod": q_avg_length_by_tod,
    "earning_per_mile": q_earning_per_mile,
    "daily_wait": q_daily_wait,
    "long_wait_days": q_long_wait_days,
    "rare_pickup_slots": q_rare_pickup_slots,
    "evening_pickups": q_evening_pickups,
    "borough_pair_count": q_borough_pair_count,
    "top_zone_routes": q_top_zone_routes,
    "merge_zones_unique": q_merge_zones_unique,
    "monthly_trips_unique": q_monthly_trips_unique,
    "merge_zones_fanout": q_merge_zones_fanout,
    "merge_zones_fanout_unique": q_merge_zones_fanout_unique,
    "merge_zones_shuffled": q_merge_zones_shuffled,
    "merge_zones_typed": q_merge_zones_typed,
    "merge_zones_typed_shuffled": q_merge_zones_typed_shuffled,
}
