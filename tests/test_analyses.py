"""Every analysis on the hand-made fixture, one assertion per pinned rule."""

from __future__ import annotations

import pytest

from ridelens.plans import analyses as A
from ridelens.plans import series as S

from conftest import rows


def test_monthly_business_aggregates(merged):
    # null business gives key "2" (concat_ws skips nulls); float noise kept
    trips = dict(rows(A.monthly_trips(merged), "business_month", "trip_count"))
    assert trips == {"2": 1, "Lyft-1": 3, "Uber-1": 3, "Via-2": 1}
    profit = dict(rows(A.monthly_profit(merged), "business_month", "total_profit"))
    assert profit["Lyft-1"] == pytest.approx(0.9999999776482582, abs=1e-12)
    assert profit["Uber-1"] == pytest.approx(1.550000011920929, abs=1e-12)
    assert profit["2"] == 1.0 and profit["Via-2"] == 1.0
    earnings = dict(rows(A.monthly_earnings(merged), "business_month", "total_earnings"))
    assert earnings["Lyft-1"] == 16.5
    assert earnings["Uber-1"] == pytest.approx(10.110000230371952, abs=1e-12)


def test_two_januaries_merge(merged):
    # 2023-01 and 2024-01 trips of Lyft are one business-month
    parts = A.with_date_parts(merged).filter("business = 'Lyft'")
    assert sorted(r["year"] for r in parts.collect()) == [2023, 2023, 2024]
    assert {r["business_month"] for r in parts.collect()} == {"Lyft-1"}


def test_series_equals_three_aggregates(merged):
    series = {r["business_month"]: r for r in S.business_month_series(merged).collect()}
    for bm, n in rows(A.monthly_trips(merged), "business_month", "trip_count"):
        assert series[bm]["trip_count"] == n
    for bm, p in rows(A.monthly_profit(merged), "business_month", "total_profit"):
        assert series[bm]["total_profit"] == pytest.approx(p, abs=1e-12)
    keys = [r["business_month"] for r in S.business_month_series(merged).collect()]
    assert keys == sorted(keys)


def test_log_series_null_for_non_positive(spark, merged):
    logs = {r["business_month"]: r for r in S.business_month_log_series(merged).collect()}
    assert logs["Lyft-1"]["log_trip_count"] == pytest.approx(0.47712125, abs=1e-8)
    assert logs["Uber-1"]["log_total_profit"] == pytest.approx(0.19033, abs=1e-4)


def test_top_pickup_boroughs_keeps_null_group_and_ties(merged):
    got = A.top_pickup_boroughs(merged).collect()
    assert [tuple(r) for r in got] == [
        ("Brooklyn", 1, 3),
        ("Staten Island", 1, 2),
        (None, 1, 1),
        (None, 2, 1),  # tie at rank 1 in February: both kept, borough breaks it
        ("Brooklyn", 2, 1),
    ]
    assert A.top_pickup_boroughs(merged).columns == ["Pickup_Borough", "Month", "trip_count"]


def test_top_k_cut_keeps_ties(merged):
    # k=1 in February: null and Brooklyn both have rank 1
    feb = [tuple(r) for r in A.top_pickup_boroughs(merged, k=1).collect() if r["Month"] == 2]
    assert len(feb) == 2


def test_top_dropoff_boroughs(merged):
    got = rows(A.top_dropoff_boroughs(merged), "Dropoff_Borough", "Month", "trip_count")
    assert got == [(None, 1, 1), (None, 2, 1), ("Brooklyn", 1, 3), ("Brooklyn", 2, 1), ("Staten Island", 1, 2)]


def test_top_borough_routes(merged):
    got = [(r["Route"], round(r["total_profit"], 6)) for r in A.top_borough_routes(merged).collect()]
    assert got == [
        ("Brooklyn to Staten Island", 18.01),
        ("Staten Island to Brooklyn", 5.5),
        ("Brooklyn", 3.1),
        ("", 1.0),  # tie with the next row: Route ascending breaks it
        ("Brooklyn to Brooklyn", 1.0),
    ]
    assert len(A.top_borough_routes(merged, n=2).collect()) == 2


def test_averages_by_time_of_day(merged):
    pay = [(r[0], round(r[1], 6)) for r in A.avg_pay_by_time_of_day(merged).collect()]
    assert pay[0] == ("evening", 6.6275)
    assert sorted(pay[1:], key=str) == sorted([("night", 1.0), (None, 1.0), ("morning", 0.1)], key=str)
    length = [(r[0], r[1]) for r in A.avg_length_by_time_of_day(merged).collect()]
    assert length[0] == ("morning", 3.0) and length[1] == ("evening", 2.25)
    assert length[-1] == ("night", 0.0)


def test_earning_per_mile_single_pass_equals_join(merged):
    single = [(r[0], None if r[1] is None else round(r[1], 6)) for r in A.earning_per_mile(merged).collect()]
    assert single == [("evening", 2.945556), ("morning", 0.033333), ("night", None)]
    joined = rows(A.join_two_aggregates(merged), "time_of_day", "average_earning_per_mile")
    assert sorted((t, None if v is None else round(v, 6)) for t, v in joined if True) == sorted(
        single, key=lambda x: x[0]
    )


def test_daily_wait(merged):
    got = [tuple(r) for r in A.daily_wait(merged).collect()]
    # day 1 merges 2023 and 2024; day 4 has only a null wait
    assert got == [(1, 250.0), (2, 500.0), (3, 7.0), (4, None)]
    assert [tuple(r) for r in A.long_wait_days(A.daily_wait(merged)).collect()] == [(2, 500.0)]
    flagged = [tuple(r) for r in S.wait_series_flagged(merged).collect()]
    assert flagged[1] == (2, 500.0, True) and flagged[3] == (4, None, None)


def test_daily_wait_other_month_truncates_fraction(merged):
    # February: '301.7' counts as 301, like the old cast
    got = [tuple(r) for r in A.daily_wait(merged, month=2).collect()]
    assert got == [(1, 151.0)]


def test_rare_pickup_slots(merged):
    got = rows(A.rare_pickup_slots(merged), "Pickup_Borough", "time_of_day", "trip_count")
    assert got == [
        (None, "evening", 1), (None, "night", 1),
        ("Brooklyn", None, 1), ("Brooklyn", "evening", 2), ("Brooklyn", "morning", 1),
        ("Staten Island", "evening", 1), ("Staten Island", "morning", 1),
    ]
    assert A.rare_pickup_slots(merged, 1, 1000).count() == 1
    assert A.rare_pickup_slots(merged).columns == ["Pickup_Borough", "time_of_day", "trip_count"]


def test_evening_pickups(merged):
    out = A.pickups_at_time(merged)
    assert out.columns == ["Pickup_Borough", "time_of_day", "trip_count"]
    assert rows(out, "Pickup_Borough", "trip_count") == [(None, 1), ("Brooklyn", 2), ("Staten Island", 1)]


def test_borough_pair(merged):
    assert A.borough_pair_count(merged).first()["trip_count"] == 2
    trips = A.borough_pair_trips(merged).collect()
    assert [tuple(r) for r in trips] == [("Brooklyn", "Staten Island", "A")] * 2
    assert A.borough_pair_sample(merged, n=1).count() == 1
    assert A.borough_pair_count(merged, "Queens", "Brooklyn").first()["trip_count"] == 0


def test_zone_routes(merged):
    got = rows(A.route_counts_by_business(merged), "Route", "uber_count", "lyft_count", "total_count")
    assert got == [(None, 1, 1, 2), ("A to A", 0, 0, 0), ("A to B", 1, 1, 2), ("B to A", 1, 1, 2)]
    top = [tuple(r) for r in A.top_zone_routes(merged, n=2).collect()]
    # three routes tie at 2: null first, then by text
    assert top == [(None, 1, 1, 2), ("A to B", 1, 1, 2)]


def test_row_count(merged):
    assert A.row_count(merged).first()["row_count"] == 8
