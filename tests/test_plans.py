"""Physical plan shapes: the strategies the design relies on at scale."""

from __future__ import annotations

from ridelens.operators.zone_merge import enrich
from ridelens.plans import analyses as A
from ridelens.sources.star import load_inputs

from conftest import SF_SMALL, count_nodes, plan_text


def _merged(spark, unique=False):
    trips, zones = load_inputs(spark, SF_SMALL)
    return enrich(trips, zones, unique_zones=unique)


def test_merge_broadcasts_lookup(spark):
    plan = plan_text(_merged(spark).select("Pickup_Zone", "Dropoff_Zone"))
    assert count_nodes(plan, "BroadcastHashJoin") == 2
    assert "LeftOuter" in plan
    assert "SortMergeJoin" not in plan


def test_unused_zone_joins_removed_when_ids_unique(spark):
    # test zones have unique ids, so the checked lookup lets Catalyst drop
    # both joins when no zone column is read
    plan = plan_text(A.monthly_trips(_merged(spark)))
    assert "Join" not in plan
    plan = plan_text(A.top_pickup_boroughs(_merged(spark)))
    assert count_nodes(plan, "BroadcastHashJoin") == 1


def test_unused_zone_joins_kept_with_duplicate_ids(spark, trips, zones):
    dup = zones.unionByName(spark.createDataFrame([("1", "X", "Y", "Z")], zones.schema))
    plan = plan_text(A.monthly_trips(enrich(trips, dup)))
    assert count_nodes(plan, "BroadcastHashJoin") == 2


def test_column_pruning_reaches_scan(spark):
    plan = plan_text(A.avg_pay_by_time_of_day(_merged(spark)))
    read_schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert read_schemas == ["ReadSchema: struct<time_of_day:string,driver_total_pay:string>"]


def test_filter_pushed_to_scan(spark):
    plan = plan_text(A.pickups_at_time(_merged(spark)))
    assert "PushedFilters: [IsNotNull(time_of_day), EqualTo(time_of_day,evening)]" in plan


def test_pair_filter_pushed_into_lookup_and_joins_become_inner(spark):
    # The borough predicates run on the (tiny) lookup side before it is
    # broadcast, and turn both left joins into inner joins.
    plan = plan_text(A.borough_pair_count(_merged(spark), "ASIA", "EUROPE"))
    assert "(Pickup_Borough" in plan and "= ASIA)" in plan
    assert "(Dropoff_Borough" in plan and "= EUROPE)" in plan
    assert "LeftOuter" not in plan and count_nodes(plan, "BroadcastHashJoin") == 2


def test_partial_aggregation_before_shuffle(spark):
    plan = plan_text(A.monthly_trips(_merged(spark)))
    assert "partial_count" in plan


def test_top_k_per_group_uses_window_group_limit(spark):
    plan = plan_text(A.top_pickup_boroughs(_merged(spark)))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_top_n_uses_take_ordered(spark):
    for df in (A.top_borough_routes(_merged(spark)), A.top_zone_routes(_merged(spark))):
        assert "TakeOrderedAndProject" in plan_text(df)


def test_earning_per_mile_is_one_aggregate(spark):
    single = plan_text(A.earning_per_mile(_merged(spark)))
    assert "Join" not in single
    assert count_nodes(single, "HashAggregate") == 2  # partial + final, one scan
    joined = plan_text(A.join_two_aggregates(_merged(spark)))
    assert "Join" in joined


def test_no_python_in_any_plan(spark):
    from ridelens.plans.registry import QUERIES

    for name, query in QUERIES.items():
        if name in ("scan_csv_header", "sink_csv_roundtrip"):
            continue
        plan = plan_text(query(spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_unique_form_has_no_join(spark):
    # SURVEY §5: no join in monthly_trips_unique, whatever the lookup holds
    plan = plan_text(A.monthly_trips(_merged(spark, unique=True)))
    assert "Join" not in plan
