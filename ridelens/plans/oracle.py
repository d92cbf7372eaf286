"""Reference answers as DuckDB SQL over the raw test tables.

Every string builds the trip and zone views from the star tables with the
same mapping as ``ridelens.sources.star`` and answers one key of
``ridelens.plans.registry.QUERIES`` with independent SQL. DuckDB returns
BIGINT for date parts and HUGEINT for integer sums, so those are cast back
to Spark's INTEGER / BIGINT; a division guards its zero with NULLIF.
"""

from __future__ import annotations

_BASE = """
trips AS (
  SELECT
    CASE l_returnflag WHEN 'R' THEN 'Uber' WHEN 'A' THEN 'Lyft' ELSE 'Other' END AS business,
    CASE c_nationkey WHEN 7 THEN '07' ELSE CAST(c_nationkey AS VARCHAR) END AS pickup_location,
    CASE s_nationkey WHEN 7 THEN '07' ELSE CAST(s_nationkey AS VARCHAR) END AS dropoff_location,
    CAST(l_quantity AS VARCHAR) AS trip_length,
    CASE WHEN l_linenumber = 7 THEN NULL
         ELSE CAST((l_partkey * 7 + l_suppkey * 13) % 600 AS VARCHAR) END AS request_to_pickup,
    CAST(l_linenumber * 300 AS VARCHAR) AS total_ride_time,
    CAST(CAST(epoch(l_shipdate) AS BIGINT) AS VARCHAR) AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'evening' WHEN '2-HIGH' THEN 'afternoon'
         WHEN '3-MEDIUM' THEN 'night' WHEN '4-NOT SPECIFIED' THEN 'morning' END AS time_of_day,
    CAST(l_extendedprice AS VARCHAR) AS driver_total_pay,
    CAST(l_extendedprice * (l_discount - l_tax) AS VARCHAR) AS rideshare_profit
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
),
zones AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS LocationID, r_name AS Borough, n_name AS Zone, n_name AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
zones_u AS (
  SELECT * FROM zones
  QUALIFY row_number() OVER (PARTITION BY LocationID
                             ORDER BY Borough NULLS FIRST, Zone NULLS FIRST, service_zone NULLS FIRST) = 1
)
"""


def _merged(name: str, zones: str) -> str:
    return f"""
{name} AS (
  SELECT t.business, t.pickup_location, t.dropoff_location, t.trip_length, t.request_to_pickup,
         t.total_ride_time,
         strftime(epoch_ms(TRY_CAST(t.date AS BIGINT) * 1000), '%Y-%m-%d') AS date,
         t.time_of_day, t.driver_total_pay, t.rideshare_profit,
         p.Borough AS Pickup_Borough, p.Zone AS Pickup_Zone, p.service_zone AS Pickup_service_zone,
         d.Borough AS Dropoff_Borough, d.Zone AS Dropoff_Zone, d.service_zone AS Dropoff_service_zone
  FROM trips t
  LEFT JOIN {zones} p ON t.pickup_location = p.LocationID
  LEFT JOIN {zones} d ON t.dropoff_location = d.LocationID
)
"""


# The lookup with zone 3 listed twice, and its merges; the trips with numeric ids.
_FANOUT = """
zones_2 AS (
  SELECT * FROM zones
  UNION ALL SELECT LocationID, Borough, Zone || ' 2', service_zone FROM zones WHERE LocationID = '3'
),
zones_2u AS (
  SELECT LocationID, min(Borough) AS Borough, min(Zone) AS Zone, min(service_zone) AS service_zone FROM zones_2 GROUP BY 1
)"""
_TYPED = """
typed AS (
  SELECT t.business, CAST(t.pickup_location AS INTEGER) AS pickup_location, CAST(t.dropoff_location AS INTEGER) AS dropoff_location,
         CAST(t.trip_length AS DOUBLE) AS trip_length, CAST(t.request_to_pickup AS INTEGER) AS request_to_pickup,
         strftime(epoch_ms(CAST(t.date AS BIGINT) * 1000), '%Y-%m-%d') AS "Date", t.time_of_day,
         CAST(t.driver_total_pay AS DOUBLE) AS "driver_pay"
  FROM trips t
)"""


_PREFIX = "WITH " + _BASE + "," + _merged("merged", "zones") + "," + _merged("merged_u", "zones_u")

MONTH = "CAST(month(TRY_CAST(date AS DATE)) AS INTEGER)"
YEAR = "CAST(year(TRY_CAST(date AS DATE)) AS INTEGER)"
DAY = "CAST(day(TRY_CAST(date AS DATE)) AS INTEGER)"
BUSINESS_MONTH = f"concat_ws('-', business, CAST({MONTH} AS VARCHAR))"
BOROUGH_ROUTE = "concat_ws(' to ', Pickup_Borough, Dropoff_Borough)"
ZONE_ROUTE = "(Pickup_Zone || ' to ' || Dropoff_Zone)"
WAIT = "TRY_CAST(trunc(TRY_CAST(request_to_pickup AS DOUBLE)) AS INTEGER)"
SERIES = f"""
series AS (
  SELECT {BUSINESS_MONTH} AS business_month,
         count(*) AS trip_count,
         sum(TRY_CAST(rideshare_profit AS FLOAT)) AS total_profit,
         sum(TRY_CAST(driver_total_pay AS FLOAT)) AS total_earnings
  FROM merged GROUP BY 1
)"""
DAILY = f"""
daily AS (
  SELECT {DAY} AS day, CAST(sum({WAIT}) AS DOUBLE) / NULLIF(count({WAIT}), 0) AS average_waiting_time
  FROM merged WHERE {MONTH} = 1 GROUP BY 1
)"""


def _q(body: str, *ctes: str) -> str:
    extra = "".join("," + c for c in ctes)
    return _PREFIX + extra + "\n" + body.strip()


def _top_places(place: str) -> str:
    return _q(
        f"""
SELECT {place}, Month, trip_count FROM (
  SELECT {place}, Month, trip_count,
         rank() OVER (PARTITION BY Month ORDER BY trip_count DESC) AS rk
  FROM (SELECT {place}, {MONTH} AS Month, count(*) AS trip_count FROM merged GROUP BY 1, 2)
) WHERE rk <= 5"""
    )


def _month_counts(place: str) -> str:
    return _q(f"SELECT {place}, {MONTH} AS Month, count(*) AS trip_count FROM merged GROUP BY 1, 2")


ROUTE_COUNTS = f"""
SELECT {ZONE_ROUTE} AS Route,
       CAST(sum(CASE WHEN business = 'Uber' THEN 1 ELSE 0 END) AS BIGINT) AS uber_count,
       CAST(sum(CASE WHEN business = 'Lyft' THEN 1 ELSE 0 END) AS BIGINT) AS lyft_count,
       CAST(sum(CASE WHEN business = 'Uber' THEN 1 ELSE 0 END)
          + sum(CASE WHEN business = 'Lyft' THEN 1 ELSE 0 END) AS BIGINT) AS total_count
FROM merged GROUP BY 1"""

PAIR = "Pickup_Borough = 'ASIA' AND Dropoff_Borough = 'EUROPE'"

_MERGED_TYPED = _q(
    "SELECT t.*, p.Borough AS Pickup_Borough, p.Zone AS Pickup_Zone, p.service_zone AS Pickup_service_zone, "
    "d.Borough AS Dropoff_Borough, d.Zone AS Dropoff_Zone, d.service_zone AS Dropoff_service_zone "
    "FROM typed t LEFT JOIN zones p ON CAST(t.pickup_location AS VARCHAR) = p.LocationID "
    "LEFT JOIN zones d ON CAST(t.dropoff_location AS VARCHAR) = d.LocationID",
    _TYPED,
)

ORACLE_SQL: dict[str, str] = {
    "scan_csv_header": _q("SELECT * FROM trips"),
    "sink_csv_roundtrip": _q(
        "SELECT business_month, trip_count, round(total_profit, 2) AS total_profit, "
        "round(total_earnings, 2) AS total_earnings FROM series",
        SERIES,
    ),
    "epoch_to_date": _q(
        "SELECT strftime(epoch_ms(TRY_CAST(date AS BIGINT) * 1000), '%Y-%m-%d') AS date, count(*) AS trip_count "
        "FROM trips GROUP BY 1"
    ),
    "date_parts": _q(f"SELECT {YEAR} AS year, {MONTH} AS month, {DAY} AS day, count(*) AS trip_count FROM merged GROUP BY 1, 2, 3"),
    "month_of_date": _q(f"SELECT {MONTH} AS Month, count(*) AS trip_count FROM merged GROUP BY 1"),
    "business_month_key": _q(
        f"SELECT business, {MONTH} AS month, {BUSINESS_MONTH} AS business_month, count(*) AS trip_count "
        "FROM merged GROUP BY 1, 2, 3"
    ),
    "borough_route_key": _q(
        f"SELECT Pickup_Borough, Dropoff_Borough, {BOROUGH_ROUTE} AS Route, count(*) AS trip_count FROM merged GROUP BY 1, 2, 3"
    ),
    "zone_route_key": _q(
        f"SELECT Pickup_Zone, Dropoff_Zone, {ZONE_ROUTE} AS Route, count(*) AS trip_count FROM merged GROUP BY 1, 2, 3"
    ),
    "pickup_month_counts": _month_counts("Pickup_Borough"),
    "dropoff_month_counts": _month_counts("Dropoff_Borough"),
    "rank_boroughs_by_month": _q(
        f"""
SELECT Pickup_Borough, Month, trip_count,
       CAST(rank() OVER (PARTITION BY Month ORDER BY trip_count DESC) AS INTEGER) AS rank
FROM (SELECT Pickup_Borough, {MONTH} AS Month, count(*) AS trip_count FROM merged GROUP BY 1, 2)"""
    ),
    "route_counts_by_business": _q(ROUTE_COUNTS),
    "join_two_aggregates": _q(
        """
SELECT a.time_of_day,
       round(a.average_driver_total_pay, 6) AS average_driver_total_pay,
       round(b.average_trip_length, 6) AS average_trip_length,
       round(a.average_driver_total_pay / NULLIF(b.average_trip_length, 0), 6) AS average_earning_per_mile
FROM (SELECT time_of_day, avg(TRY_CAST(driver_total_pay AS DOUBLE)) AS average_driver_total_pay
      FROM merged GROUP BY 1) a
JOIN (SELECT time_of_day, avg(TRY_CAST(trip_length AS DOUBLE)) AS average_trip_length
      FROM merged GROUP BY 1) b
  ON a.time_of_day = b.time_of_day"""
    ),
    "borough_pair_trips": _q(f"SELECT Pickup_Borough, Dropoff_Borough, Pickup_Zone FROM merged WHERE {PAIR}"),
    "borough_pair_sample": _q(
        f"SELECT Pickup_Borough, Dropoff_Borough, Pickup_Zone FROM merged WHERE {PAIR} "
        "ORDER BY Pickup_Borough NULLS FIRST, Dropoff_Borough NULLS FIRST, Pickup_Zone NULLS FIRST LIMIT 10"
    ),
    "business_month_series": _q(
        "SELECT business_month, trip_count, round(total_profit, 2) AS total_profit, "
        "round(total_earnings, 2) AS total_earnings FROM series",
        SERIES,
    ),
    "stream_business_month_series": _q(
        "SELECT business_month, trip_count, round(total_profit, 2) AS total_profit, "
        "round(total_earnings, 2) AS total_earnings FROM series",
        SERIES,
    ),
    "business_month_log_series": _q(
        """
SELECT business_month,
       round(CASE WHEN trip_count > 0 THEN log10(trip_count) END, 6) AS log_trip_count,
       round(CASE WHEN total_profit > 0 THEN log10(total_profit) END, 6) AS log_total_profit,
       round(CASE WHEN total_earnings > 0 THEN log10(total_earnings) END, 6) AS log_total_earnings
FROM series""",
        SERIES,
    ),
    "wait_series_flagged": _q(
        "SELECT day, round(average_waiting_time, 6) AS average_waiting_time, "
        "average_waiting_time > 300 AS over_threshold FROM daily",
        DAILY,
    ),
    "merge_zones": _q("SELECT * FROM merged"),
    "merged_row_count": _q("SELECT count(*) AS row_count FROM merged"),
    "monthly_trips": _q(f"SELECT {BUSINESS_MONTH} AS business_month, count(*) AS trip_count FROM merged GROUP BY 1"),
    "monthly_profit": _q(
        f"SELECT {BUSINESS_MONTH} AS business_month, round(sum(TRY_CAST(rideshare_profit AS FLOAT)), 2) AS total_profit "
        "FROM merged GROUP BY 1"
    ),
    "monthly_earnings": _q(
        f"SELECT {BUSINESS_MONTH} AS business_month, round(sum(TRY_CAST(driver_total_pay AS FLOAT)), 2) AS total_earnings "
        "FROM merged GROUP BY 1"
    ),
    "top_pickup_boroughs": _top_places("Pickup_Borough"),
    "top_dropoff_boroughs": _top_places("Dropoff_Borough"),
    "top_pickup_zones": _top_places("Pickup_Zone"),
    "top_dropoff_zones": _top_places("Dropoff_Zone"),
    "top_borough_routes": _q(
        f"""
SELECT Route, round(total_profit, 2) AS total_profit FROM (
  SELECT {BOROUGH_ROUTE} AS Route, sum(TRY_CAST(driver_total_pay AS DOUBLE)) AS total_profit
  FROM merged GROUP BY 1
) ORDER BY total_profit DESC NULLS LAST, Route ASC NULLS FIRST LIMIT 30"""
    ),
    "avg_pay_by_tod": _q(
        "SELECT time_of_day, round(avg(TRY_CAST(driver_total_pay AS DOUBLE)), 6) AS average_driver_total_pay "
        "FROM merged GROUP BY 1"
    ),
    "avg_length_by_tod": _q(
        "SELECT time_of_day, round(avg(TRY_CAST(trip_length AS DOUBLE)), 6) AS average_trip_length FROM merged GROUP BY 1"
    ),
    "earning_per_mile": _q(
        """
SELECT time_of_day,
       round(avg(TRY_CAST(driver_total_pay AS DOUBLE)) / NULLIF(avg(TRY_CAST(trip_length AS DOUBLE)), 0), 6)
         AS average_earning_per_mile
FROM merged WHERE time_of_day IS NOT NULL GROUP BY 1"""
    ),
    "daily_wait": _q("SELECT day, round(average_waiting_time, 6) AS average_waiting_time FROM daily", DAILY),
    "long_wait_days": _q(
        "SELECT day, round(average_waiting_time, 6) AS average_waiting_time FROM daily WHERE average_waiting_time > 300",
        DAILY,
    ),
    "rare_pickup_slots": _q(
        "SELECT Pickup_Borough, time_of_day, count(*) AS trip_count FROM merged GROUP BY 1, 2 "
        "HAVING count(*) > 0 AND count(*) < 1000"
    ),
    "evening_pickups": _q(
        "SELECT Pickup_Borough, 'evening' AS time_of_day, count(*) AS trip_count FROM merged "
        "WHERE time_of_day = 'evening' GROUP BY 1"
    ),
    "borough_pair_count": _q(f"SELECT count(*) AS trip_count FROM merged WHERE {PAIR}"),
    "top_zone_routes": _q(
        f"SELECT * FROM ({ROUTE_COUNTS}) ORDER BY total_count DESC NULLS LAST, Route ASC NULLS FIRST LIMIT 10"
    ),
    "merge_zones_unique": _q("SELECT * FROM merged_u"),
    "merge_zones_fanout": _q("SELECT * FROM merged_2", _FANOUT, _merged("merged_2", "zones_2")),
    "merge_zones_fanout_unique": _q("SELECT * FROM merged_2u", _FANOUT, _merged("merged_2u", "zones_2u")),
    "merge_zones_shuffled": _q("SELECT * FROM merged_2", _FANOUT, _merged("merged_2", "zones_2")),
    "merge_zones_typed": _MERGED_TYPED,
    "merge_zones_typed_shuffled": _MERGED_TYPED,
    "sink_csv_part_files": _q("SELECT CAST(1 AS BIGINT) AS part_files, count(*) AS row_count FROM series", SERIES),
    "monthly_trips_unique": _q(
        f"SELECT {BUSINESS_MONTH} AS business_month, count(*) AS trip_count FROM merged_u GROUP BY 1"
    ),
}
