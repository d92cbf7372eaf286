"""The trip analyses. Each takes the merged trip table (see
``ridelens.operators.zone_merge.enrich``) and returns a DataFrame; the defaults are
the original study's constants.

Money columns arrive as text. Monthly money totals round each value to 32-bit
float before summing (the published totals carry that noise); the other
money and mile figures are doubles. Sums of either do not depend on the order
of the rows. Bad text is null, not an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.functions.casts import to_double, to_float, to_int_truncating
from ridelens.functions.dates import day_of, month_of, year_of
from ridelens.functions.keys import borough_route, business_month, zone_route
from ridelens.operators.aggregate import count_between, count_by, count_by_category, mean_by_sum_count
from ridelens.operators.exact import aggregate_exactly
from ridelens.operators.filters import between_places, equals, in_month
from ridelens.operators.rank import top_k_per_group, top_n
from ridelens.operators.zone_merge import enrich

# The study's defaults.
TOP_K_PER_MONTH = 5
TOP_BOROUGH_ROUTES = 30
TOP_ZONE_ROUTES = 10
WAIT_MONTH = 1
WAIT_THRESHOLD_SECONDS = 300
SLOT_COUNT_LOWER = 0
SLOT_COUNT_UPPER = 1000
EVENING = "evening"
PAIR_PICKUP = "Brooklyn"
PAIR_DROPOFF = "Staten Island"
PAIR_SAMPLE_ROWS = 10
BUSINESS_COUNT_COLUMNS = {"uber_count": "Uber", "lyft_count": "Lyft"}


# Q01 ---------------------------------------------------------------------

def merge_zones(trips: DataFrame, zones: DataFrame, unique_zones: bool = False) -> DataFrame:
    """Trips with pickup and dropoff zone columns and a text date."""
    return enrich(trips, zones, unique_zones=unique_zones)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """The row count as a one-row DataFrame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(name))


# Q02 ---------------------------------------------------------------------

def with_date_parts(merged: DataFrame) -> DataFrame:
    """Adds ``year``, ``month`` and ``business_month``. ``year`` is carried
    but never part of a key: two Januaries fall into one business-month."""
    return (
        merged.withColumn("year", year_of("date"))
        .withColumn("month", month_of("date"))
        .withColumn("business_month", business_month("business", F.col("month").cast("string")))
    )


def _business_month_key(merged: DataFrame):
    return business_month("business", month_of("date").cast("string")).alias("business_month")


def monthly_trips(merged: DataFrame) -> DataFrame:
    """``business_month, trip_count``."""
    return count_by(merged, _business_month_key(merged), "trip_count")


def monthly_profit(merged: DataFrame) -> DataFrame:
    """``business_month, total_profit`` (float-rounded values, double sum)."""
    return aggregate_exactly(merged, [_business_month_key(merged)], sums={"total_profit": to_float("rideshare_profit")})


def monthly_earnings(merged: DataFrame) -> DataFrame:
    """``business_month, total_earnings`` (float-rounded values, double sum)."""
    return aggregate_exactly(merged, [_business_month_key(merged)], sums={"total_earnings": to_float("driver_total_pay")})


# Q03 ---------------------------------------------------------------------

def top_places_per_month(
    merged: DataFrame,
    place: str = "Pickup_Borough",
    k: int = TOP_K_PER_MONTH,
) -> DataFrame:
    """``<place>, Month, trip_count`` for the ``k`` busiest places of each
    month (ties kept), sorted by month and rank."""
    counts = count_by(merged, [F.col(place), month_of("date").alias("Month")], "trip_count")
    top = top_k_per_group(counts, "Month", "trip_count", k, tiebreak=place)
    return top.select(place, "Month", "trip_count")


def top_pickup_boroughs(merged: DataFrame, k: int = TOP_K_PER_MONTH) -> DataFrame:
    return top_places_per_month(merged, "Pickup_Borough", k)


def top_dropoff_boroughs(merged: DataFrame, k: int = TOP_K_PER_MONTH) -> DataFrame:
    return top_places_per_month(merged, "Dropoff_Borough", k)


def top_borough_routes(merged: DataFrame, n: int = TOP_BOROUGH_ROUTES) -> DataFrame:
    """``Route, total_profit``: the ``n`` borough routes with the most driver
    pay. The column keeps its original name although it sums driver pay."""
    route = borough_route("Pickup_Borough", "Dropoff_Borough").alias("Route")
    routes = aggregate_exactly(merged, [route], sums={"total_profit": to_double("driver_total_pay")})
    return top_n(routes, "total_profit", n, tiebreak="Route")


# Q04 ---------------------------------------------------------------------

def avg_pay_by_time_of_day(merged: DataFrame) -> DataFrame:
    """``time_of_day, average_driver_total_pay``, highest first; the null
    time of day is a group."""
    pay = {"average_driver_total_pay": to_double("driver_total_pay")}
    return aggregate_exactly(merged, ["time_of_day"], means=pay).orderBy(F.desc("average_driver_total_pay"))


def avg_length_by_time_of_day(merged: DataFrame) -> DataFrame:
    """``time_of_day, average_trip_length``, highest first."""
    length = {"average_trip_length": to_double("trip_length")}
    return aggregate_exactly(merged, ["time_of_day"], means=length).orderBy(F.desc("average_trip_length"))


def join_two_aggregates(merged: DataFrame) -> DataFrame:
    """The two averages above joined on ``time_of_day`` (inner: the null
    time of day drops), with their ratio."""
    joined = avg_pay_by_time_of_day(merged).join(avg_length_by_time_of_day(merged), "time_of_day")
    return joined.withColumn(
        "average_earning_per_mile",
        F.try_divide(F.col("average_driver_total_pay"), F.col("average_trip_length")),
    ).orderBy(F.desc("average_earning_per_mile"))


def earning_per_mile(merged: DataFrame) -> DataFrame:
    """``time_of_day, average_earning_per_mile``: average pay over average
    length (a ratio of averages). Same answer as :func:`join_two_aggregates`
    in one scan and one aggregate: the inner join's null-key drop becomes a
    filter that Catalyst pushes to the scan."""
    known = merged.filter(F.col("time_of_day").isNotNull())
    both = aggregate_exactly(known, ["time_of_day"], means={"_pay": to_double("driver_total_pay"), "_len": to_double("trip_length")})
    return (
        both.select("time_of_day", F.try_divide(F.col("_pay"), F.col("_len")).alias("average_earning_per_mile"))
        .orderBy(F.desc("average_earning_per_mile"))
    )


def time_of_day_averages(merged: DataFrame) -> DataFrame:
    """``time_of_day, average_driver_total_pay, average_trip_length,
    average_earning_per_mile`` of every time of day, null included: the three
    tables above in one scan."""
    columns = {"average_driver_total_pay": to_double("driver_total_pay"), "average_trip_length": to_double("trip_length")}
    both = aggregate_exactly(merged, ["time_of_day"], means=columns)
    ratio = F.try_divide("average_driver_total_pay", "average_trip_length")
    return both.withColumn("average_earning_per_mile", ratio)


# Q05 ---------------------------------------------------------------------

def daily_wait(merged: DataFrame, month: int = WAIT_MONTH) -> DataFrame:
    """``day, average_waiting_time`` for each day of ``month`` (any year),
    by day. A day whose waits are all null keeps a null average."""
    rows = in_month(merged, month).select(
        day_of("date").alias("day"), to_int_truncating("request_to_pickup").alias("_wait")
    )
    return mean_by_sum_count(rows, "day", "_wait", "average_waiting_time").orderBy("day")


def long_wait_days(daily: DataFrame, threshold: float = WAIT_THRESHOLD_SECONDS) -> DataFrame:
    """Days of a :func:`daily_wait` result whose average is above
    ``threshold``."""
    return daily.filter(F.col("average_waiting_time") > threshold)


# Q06 ---------------------------------------------------------------------

def rare_pickup_slots(
    merged: DataFrame, lower: int = SLOT_COUNT_LOWER, upper: int = SLOT_COUNT_UPPER
) -> DataFrame:
    """``Pickup_Borough, time_of_day, trip_count`` with ``lower < trip_count
    < upper``."""
    return count_between(merged, ["Pickup_Borough", "time_of_day"], lower, upper, "trip_count")


def pickups_at_time(merged: DataFrame, time_of_day: str = EVENING) -> DataFrame:
    """``Pickup_Borough, time_of_day, trip_count`` for one time of day."""
    counts = count_by(equals(merged, "time_of_day", time_of_day), "Pickup_Borough", "trip_count")
    return counts.withColumn("time_of_day", F.lit(time_of_day)).select("Pickup_Borough", "time_of_day", "trip_count")


def borough_pair_trips(merged: DataFrame, pickup: str = PAIR_PICKUP, dropoff: str = PAIR_DROPOFF) -> DataFrame:
    """``Pickup_Borough, Dropoff_Borough, Pickup_Zone`` of every trip from
    ``pickup`` to ``dropoff``."""
    return between_places(merged, pickup, dropoff).select("Pickup_Borough", "Dropoff_Borough", "Pickup_Zone")


def borough_pair_count(merged: DataFrame, pickup: str = PAIR_PICKUP, dropoff: str = PAIR_DROPOFF) -> DataFrame:
    """One row, ``trip_count``: trips from ``pickup`` to ``dropoff``."""
    return row_count(between_places(merged, pickup, dropoff), "trip_count")


def borough_pair_sample(
    merged: DataFrame,
    pickup: str = PAIR_PICKUP,
    dropoff: str = PAIR_DROPOFF,
    n: int = PAIR_SAMPLE_ROWS,
) -> DataFrame:
    """``n`` rows of :func:`borough_pair_trips`, the first ones in column
    order so the sample is repeatable."""
    trips = borough_pair_trips(merged, pickup, dropoff)
    return trips.orderBy(*[F.asc_nulls_first(c) for c in trips.columns]).limit(n)


def filter_counts(merged: DataFrame) -> DataFrame:
    """``Pickup_Borough, Dropoff_Borough, time_of_day, trip_count``: the one
    aggregate from which the filtering job's counts are summed."""
    return count_by(merged, ["Pickup_Borough", "Dropoff_Borough", "time_of_day"], "trip_count")


# Q07 ---------------------------------------------------------------------

def route_counts_by_business(
    merged: DataFrame, columns: Mapping[str, str] = BUSINESS_COUNT_COLUMNS
) -> DataFrame:
    """``Route, uber_count, lyft_count, total_count`` for every zone route.
    A trip with an unmatched zone is in the null route; a business other
    than the named ones counts 0 but its route still appears."""
    return count_by_category(
        merged, zone_route("Pickup_Zone", "Dropoff_Zone").alias("Route"), "business", columns, "total_count"
    )


def top_zone_routes(merged: DataFrame, n: int = TOP_ZONE_ROUTES) -> DataFrame:
    """The ``n`` zone routes with the most trips of the named businesses."""
    return top_n(route_counts_by_business(merged), "total_count", n, tiebreak="Route")
