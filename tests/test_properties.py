"""Cross-form properties on the whole sf0.001 tables: different plans for the
same question must agree."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ridelens.operators.aggregate import count_by
from ridelens.operators.zone_merge import enrich
from ridelens.plans import analyses as A
from ridelens.plans import series as S
from ridelens.sources.star import load_inputs

from conftest import SF_SMALL, plan_text, rows


@pytest.fixture(scope="module")
def inputs(spark):
    return load_inputs(spark, SF_SMALL)


@pytest.fixture(scope="module")
def star_merged(inputs):
    return enrich(*inputs)


def _total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_merge_keeps_row_count_when_ids_unique(inputs, star_merged):
    assert star_merged.count() == inputs[0].count() == 6000


def test_monthly_counts_sum_to_trip_count(star_merged):
    assert _total(A.monthly_trips(star_merged), "trip_count") == 6000
    assert _total(S.business_month_series(star_merged), "trip_count") == 6000


def test_unbounded_slot_counts_sum_to_trip_count(star_merged):
    slots = A.rare_pickup_slots(star_merged, lower=0, upper=10**9)
    assert _total(slots, "trip_count") == 6000


def test_single_pass_ratio_equals_join_form(star_merged):
    single = rows(A.earning_per_mile(star_merged), "time_of_day", "average_earning_per_mile")
    joined = rows(A.join_two_aggregates(star_merged), "time_of_day", "average_earning_per_mile")
    assert [t for t, _ in single] == [t for t, _ in joined]
    for (_, a), (_, b) in zip(single, joined):
        assert a == pytest.approx(b, rel=1e-12)


def test_sum_over_count_is_average(star_merged):
    from ridelens.functions.casts import to_int_truncating
    from ridelens.functions.dates import day_of
    from ridelens.operators.filters import in_month

    daily = dict(rows(A.daily_wait(star_merged), "day", "average_waiting_time"))
    avg = in_month(star_merged, 1).groupBy(day_of("date").alias("day")).agg(
        F.avg(to_int_truncating("request_to_pickup")).alias("a")
    )
    for day, a in rows(avg, "day", "a"):
        assert daily[day] == pytest.approx(a, rel=1e-12)


def test_unique_form_equals_plain_form(inputs, star_merged):
    unique = enrich(*inputs, unique_zones=True)
    assert rows(A.monthly_trips(unique), "business_month", "trip_count") == rows(
        A.monthly_trips(star_merged), "business_month", "trip_count"
    )


def test_top_k_is_subset_of_ranked_counts(star_merged):
    counts = {
        (b, m): n
        for b, m, n in rows(count_by(star_merged, ["Pickup_Zone", A.month_of("date").alias("Month")]), "Pickup_Zone", "Month", "trip_count")
    }
    top = rows(A.top_places_per_month(star_merged, "Pickup_Zone"), "Pickup_Zone", "Month", "trip_count")
    for zone, month, n in top:
        assert counts[(zone, month)] == n
        bigger = sum(1 for (z, m), c in counts.items() if m == month and c > n)
        assert bigger < 5


def test_top_n_is_prefix_of_all_routes(star_merged):
    allr = rows(A.route_counts_by_business(star_merged), "Route", "total_count")
    top = [tuple(r) for r in A.top_zone_routes(star_merged).select("Route", "total_count").collect()]
    ordered = sorted(allr, key=lambda t: (-t[1], t[0] is not None, t[0] or ""))
    assert top == ordered[:10]


def test_shuffle_path_equals_broadcast_path_on_whole_tables(spark, inputs, star_merged):
    """The merge beyond the broadcast bound (hot ids dealt over salts, plain
    shuffle join otherwise) gives the same merged table and answers."""
    from ridelens.operators.zone_merge import count_trip_ids, hot_ids

    trips, zones = inputs
    # every nation holds ~4% of 6,000 trips
    counts = count_trip_ids(trips)
    assert hot_ids(counts, "Pickup", 100).count() >= 20 and hot_ids(counts, "Pickup", 600).count() == 0
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        cols = star_merged.columns
        want = rows(star_merged, *cols)
        # fixed buckets for every hot id; none hot; buckets sized from counts
        for fixed, per_task in ((4, 100), (None, 2_000_000), (None, 100)):
            shuffled = enrich(trips, zones, broadcast_max_rows=1, salt_buckets=fixed, rows_per_salt_task=per_task)
            assert "SortMergeJoin" in plan_text(shuffled)
            assert rows(shuffled, *cols) == want
            assert rows(A.top_zone_routes(shuffled), "Route", "total_count") == rows(
                A.top_zone_routes(star_merged), "Route", "total_count"
            )
    finally:
        spark.conf.set(key, old)
