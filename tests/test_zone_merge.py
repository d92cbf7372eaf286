"""The pickup / dropoff merge: left joins, string keys, fan-out, both join
strategies."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from ridelens.operators.zone_merge import count_trip_ids, enrich, hot_ids, prepare_lookup, trip_address, unique_lookup
from ridelens.sources.readers import TRIP_COLUMNS

from conftest import SF_SMALL, count_nodes, plan_text, rows

ZONE_OUT = [f"{r}_{a}" for r in ("Pickup", "Dropoff") for a in ("Borough", "Zone", "service_zone")]


def test_columns_and_row_count(merged):
    assert merged.columns == list(TRIP_COLUMNS) + ZONE_OUT
    assert merged.count() == 8


def test_unmatched_ids_give_nulls(merged):
    got = {
        (r["pickup_location"], r["dropoff_location"]): (r["Pickup_Zone"], r["Dropoff_Zone"])
        for r in merged.collect()
    }
    assert got[("1", "9")] == ("A", None)
    assert got[("9", "9")] == (None, None)
    # ids compare as strings: '01' is not '1'
    assert got[("01", "1")] == (None, "A")


def test_date_replaced_by_text(merged):
    assert sorted(r["date"] for r in merged.collect())[0] == "2023-01-01"


def _dup_zones(spark, zones):
    extra = spark.createDataFrame([("1", "Brooklyn", "A2", "Boro")], zones.schema)
    return zones.unionByName(extra)


def test_duplicate_ids_fan_out(spark, trips, zones):
    dup = _dup_zones(spark, zones)
    assert not prepare_lookup(dup).unique_ids
    assert enrich(trips, dup).count() == 17
    assert enrich(trips, dup, unique_zones=True).count() == 8


def test_unique_lookup_is_deterministic(spark, zones):
    dup = _dup_zones(spark, zones)
    got = rows(unique_lookup(dup), "LocationID", "Zone")
    assert got == [("1", "A"), ("2", "B"), ("3", "C")]


def test_prepare_lookup(zones):
    lk = prepare_lookup(zones)
    assert (lk.rows, lk.broadcastable, lk.unique_ids) == (3, True, True)
    # 3 rows x 4 values: text length plus 8 per value
    assert lk.bytes == len("1BrooklynABoro2Staten IslandBBoro3QueensCBoro") + 12 * 8
    small = prepare_lookup(zones, broadcast_max_rows=2)
    assert (small.broadcastable, small.unique_ids) == (False, True)
    wide = prepare_lookup(zones, broadcast_max_bytes=10)
    assert (wide.broadcastable, wide.unique_ids) == (False, True)


def test_salted_shuffle_join_matches_broadcast(spark, trips, zones):
    dup = _dup_zones(spark, zones)
    for lookup in (zones, dup):
        cols = list(TRIP_COLUMNS) + ZONE_OUT
        broadcast = rows(enrich(trips, lookup), *cols)
        shuffled = rows(enrich(trips, lookup, broadcast_max_rows=1, salt_buckets=4), *cols)
        assert shuffled == broadcast


@contextmanager
def _plain_shuffle(spark):
    """Neither Catalyst's own broadcasts nor runtime re-planning."""
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_only_the_bounded_id_list_is_broadcast_on_the_shuffle_path(spark, trips, zones):
    with _plain_shuffle(spark):
        plan = plan_text(enrich(trips, zones, broadcast_max_rows=1))
    assert count_nodes(plan, "SortMergeJoin") == 2  # the two merges
    assert "LeftOuter" in plan and "CartesianProduct" not in plan


def test_unread_merges_go_at_any_lookup_size(spark):
    # The lookup's ids are unique, so nothing of the merge is left in a plan
    # that reads no zone column: no join, no count of ids, one exchange.
    from ridelens.plans import analyses as A
    from ridelens.sources.star import load_inputs

    trips, big = load_inputs(spark, SF_SMALL)
    with _plain_shuffle(spark):
        plan = plan_text(A.monthly_trips(enrich(trips, big, broadcast_max_rows=1)))
    assert "Join" not in plan and count_nodes(plan, "Exchange") == 1


def test_unique_form_equals_plain_when_ids_unique(trips, zones):
    cols = list(TRIP_COLUMNS) + ZONE_OUT
    assert rows(enrich(trips, zones), *cols) == rows(enrich(trips, zones, unique_zones=True), *cols)


def _many(spark, pickup, n=8000, extra=""):
    return spark.range(n).selectExpr(
        "'Uber' AS business", f"{pickup} AS pickup_location", "'2' AS dropoff_location",
        "'1.0' AS trip_length", "'60' AS request_to_pickup", "'600' AS total_ride_time",
        "'1672531200' AS date", "'evening' AS time_of_day",
        "'10.0' AS driver_total_pay", "'1.0' AS rideshare_profit", *([extra] if extra else []),
    )


def _largest_task(merged):
    per_task = merged.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return max(r["count"] for r in per_task)


def _spread_lookup(spark, zones):
    """The pickup role alone, with a lookup that has many other ids."""
    more = spark.range(100, 400).selectExpr("CAST(id AS STRING) LocationID", "'b' Borough", "'z' Zone", "'s' service_zone")
    return zones.unionByName(more)


@pytest.mark.parametrize(
    "pickup",
    [
        "'1'",  # one id has all trips, all of them equal
        "CASE WHEN id % 10 = 0 THEN CAST(id AS STRING) END",  # nine of ten have none
        "CASE WHEN id % 3 = 0 THEN '1' ELSE CAST(100 + id % 300 AS STRING) END",  # a third
    ],
)
def test_no_task_holds_a_hot_id(spark, zones, pickup):
    trips = _many(spark, pickup)
    with _plain_shuffle(spark):
        merged = enrich(trips, _spread_lookup(spark, zones), broadcast_max_rows=1, rows_per_salt_task=200)
        largest = _largest_task(merged.drop("dropoff_location", "Dropoff_Borough", "Dropoff_Zone", "Dropoff_service_zone"))
        assert merged.count() == 8000
        matched = merged.where("Pickup_Zone = 'A'").count()
    assert matched == trips.where("pickup_location = '1'").count()
    assert largest < 8000 / 3


def test_an_id_below_a_hundredth_is_dealt_out_too(spark):
    trips = _many(spark, "CASE WHEN id < 72 THEN '1' ELSE CAST(id AS STRING) END")  # 0.9 %
    got = {r["id"]: r["buckets"] for r in hot_ids(count_trip_ids(trips), "Pickup", rows_per_task=20).collect()}
    assert got == {"1": 4}


def test_hot_ids_follow_the_trip_count(trips):
    # pickups: '1' x4, '2' x2, '9' x1, '01' x1; dropoffs: '1' x4, '2' x2, '9' x2
    counts = count_trip_ids(trips)
    assert (counts.total, counts.without_id) == (8, {"Pickup": 0, "Dropoff": 0})
    found = lambda *a, **k: {r["id"]: r["buckets"] for r in hot_ids(counts, *a, **k).collect()}
    assert found("Pickup", rows_per_task=3) == {"1": 2}
    assert found("Dropoff", rows_per_task=1) == {"1": 4, "2": 2, "9": 2}
    assert found("Dropoff", rows_per_task=1, salt_buckets=7) == {"1": 7, "2": 7, "9": 7}
    assert found("Pickup") == {}


def test_names_and_types_pass_through(spark, zones):
    trips = _many(spark, "1", 6, "map('k', id) AS m").withColumnRenamed("date", "DATE").withColumn("fare.base", F.lit(2.5))
    trips = trips.unionByName(trips.limit(1).withColumn("pickup_location", F.lit(None).cast("int")))
    lookup = zones.unionByName(spark.createDataFrame([("N/A", "x", "y", "z")], zones.schema))
    for most in (10**6, 1):
        out = enrich(trips, lookup, broadcast_max_rows=most, rows_per_salt_task=2)
        assert out.columns == [*trips.columns, *ZONE_OUT]
        got = out.collect()
        assert len(got) == 7 and {r["DATE"] for r in got} == {"2023-01-01"} and {r["fare.base"] for r in got} == {2.5}
        assert sorted(str(r["Pickup_Zone"]) for r in got) == ["A"] * 6 + ["None"]
        assert {next(iter(r["m"].values())) for r in got} == set(range(6))
        from ridelens.plans import analyses as A

        assert {r["business_month"] for r in A.monthly_trips(out).collect()} == {"Uber-1"}


def test_lookup_bytes_count_bytes(spark, zones):
    wide = spark.createDataFrame([("1", "区" * 10, "市", "町")], zones.schema)
    assert prepare_lookup(wide).bytes == 1 + 3 * 12 + 4 * 8


def test_mixed_hot_and_cold_keys_match_broadcast(spark, trips, zones):
    dup = zones.unionByName(spark.createDataFrame([("2", "Staten Island", "B2", "Boro")], zones.schema))
    cols = list(TRIP_COLUMNS) + ZONE_OUT
    for lookup in (zones, dup):
        broadcast = rows(enrich(trips, lookup), *cols)
        shuffled = rows(enrich(trips, lookup, broadcast_max_rows=1, salt_buckets=3, rows_per_salt_task=1), *cols)
        assert shuffled == broadcast


def test_an_empty_trip_table_and_trips_without_ids(spark, trips, zones):
    assert count_trip_ids(trips.limit(0)).total == 0
    assert enrich(trips.limit(0), zones, broadcast_max_rows=1).count() == 0
    none = trips.withColumn("pickup_location", F.lit(None).cast("string"))
    assert count_trip_ids(none).without_id == {"Pickup": 8, "Dropoff": 0}
    assert enrich(none, zones, broadcast_max_rows=1, rows_per_salt_task=2).count() == 8


def _written(spark, tmp_dir, n=4000):
    """Trips in several parquet files; many are equal in all their values."""
    path = f"{tmp_dir}/trips"
    _many(spark, "CASE WHEN id % 3 > 0 THEN '1' END", n, "id % 5 AS five").repartition(6, "five").write.parquet(path)
    return path


def _salts(merged_input):
    """(address, both salts) of every trip, as the merge draws them."""
    from ridelens.operators import zone_merge as Z

    counts = count_trip_ids(merged_input)
    out = merged_input.withColumn(Z._ADDRESS, trip_address(merged_input))
    for role in Z.ROLES:
        hot = hot_ids(counts, role, 100)
        lookup = Z._role_lookup(merged_input.sparkSession.createDataFrame([("1", "b", "z", "s")], "LocationID string, Borough string, Zone string, service_zone string"), role)
        out, *_ = Z._salted(out, lookup, role, hot, 40, 8)
        # What a shuffle and a join before the next role do to the order of the rows.
        out = out.repartition(7, Z._ADDRESS).sortWithinPartitions(F.rand())
    return out


def test_salts_do_not_depend_on_the_order_of_rows(spark, tmp_dir):
    path = _written(spark, tmp_dir)
    got = []
    for split in ("128m", "2k"):  # other tasks read other ranges of the files
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            salted = _salts(spark.read.parquet(path))
            got.append(sorted(salted.select("_trip_address", "_pickup_salt", "_dropoff_salt").collect()))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[0] == got[1]
    assert len({r[0] for r in got[0]}) == 4000  # equal trips have addresses of their own
    assert len({r[1] for r in got[0]}) == 40 and len({r[2] for r in got[0]}) == 40


def test_nothing_is_drawn_behind_an_exchange(spark, zones, tmp_dir, trips_path):
    from ridelens.sources.readers import read_trips

    path = _written(spark, tmp_dir)
    plain = spark.read.parquet(path)
    shuffled = plain.repartition(5).drop("five")
    cases = {"files": plain, "header csv": read_trips(spark, trips_path), "made": _many(spark, "'1'"), "shuffled": shuffled, "aggregated": plain.groupBy(*plain.columns).count()}
    with _plain_shuffle(spark):
        for name, trips in cases.items():
            lines = plan_text(enrich(trips, zones, broadcast_max_rows=1, rows_per_salt_task=50)).split("\n\n")[0].split("\n")
            tree = enrich(trips, zones, broadcast_max_rows=1, rows_per_salt_task=50)._jdf.queryExecution().executedPlan().toString().split("\n")
            drawn = [i for i, line in enumerate(tree) if "monotonically_increasing_id" in line or "rand(" in line]
            assert lines and len(drawn) <= 1, name
            assert bool(drawn) == (name in ("header csv", "made")), name
            for i in drawn:
                depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
                below = []
                for line in tree[i + 1 :]:
                    if depth(line) < depth(tree[i]):
                        break
                    below.append(line)
                assert not any("Exchange" in line for line in below), name


def test_the_ids_are_read_once_for_both_roles(spark, tmp_dir):
    import json
    import os
    import subprocess
    import sys

    code = f"""
import os, json
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", "{tmp_dir}/scratch").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "{tmp_dir}/events")
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate())
from ridelens.operators.zone_merge import enrich
trips = spark.read.parquet("{tmp_dir}/trips")
zones = spark.createDataFrame([("1", "b", "z", "s"), ("1", "c", "z", "s")], "LocationID string, Borough string, Zone string, service_zone string")
enrich(trips, zones, broadcast_max_rows=1, rows_per_salt_task=100).write.format("noop").mode("overwrite").save()
spark.stop()
"""
    _written(spark, tmp_dir)
    os.makedirs(f"{tmp_dir}/events")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, env={**os.environ, "PYTHONPATH": root}, timeout=240)
    read = 0
    for name in os.listdir(f"{tmp_dir}/events"):
        with open(f"{tmp_dir}/events/{name}") as fh:
            for line in fh:
                event = json.loads(line)
                if event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                    read += event["Task Metrics"]["Input Metrics"]["Records Read"] * (event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"] == 0)
    # Once for the counts, once for the merge itself; the rest are the few rows of the counts.
    assert 8000 <= read < 8100


def test_salts_stop_where_every_shuffle_partition_has_the_id(spark, zones, monkeypatch):
    from ridelens.operators import zone_merge as Z

    trips = _many(spark, "CASE WHEN id % 2 = 0 THEN '1' END", extra="id")
    most = Z.SALTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    seen, salted = [], Z._salted
    monkeypatch.setattr(Z, "_salted", lambda *a: seen.append(salted(*a)) or seen[-1])
    merged = enrich(trips, zones, broadcast_max_rows=1, rows_per_salt_task=10)
    # By the trip counts alone it would be 400 and 800 copies of the hot id's row.
    assert [copies.count() for _, copies, *_ in seen] == [most + 2, most + 2]
    drawn = seen[0][0].groupBy("pickup_location").agg(F.count_distinct("_pickup_salt").alias("n"))
    assert {r["pickup_location"]: r["n"] for r in drawn.collect()} == {"1": most, None: most}
    cols = ["id", "pickup_location", "dropoff_location", *ZONE_OUT]
    assert rows(merged, *cols) == rows(enrich(trips, zones), *cols)
