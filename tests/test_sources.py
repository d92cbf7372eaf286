"""Readers, the CSV sink, session helpers."""

from __future__ import annotations

import datetime
import glob
import os

import pytest
from pyspark.sql import functions as F

from ridelens.plans import analyses as A
from ridelens.session import object_store_conf, scratch_dir
from ridelens.sources.readers import TRIP_COLUMNS, TRIP_SCHEMA, read_trips
from ridelens.sources.sinks import export_csv


def test_csv_header_scan_gives_strings(trips):
    assert trips.columns == list(TRIP_COLUMNS)
    assert {f.dataType.simpleString() for f in trips.schema.fields} == {"string"}
    # empty field -> null
    assert trips.filter("business IS NULL").count() == 1


def test_csv_scan_with_declared_schema(spark, tmp_dir, trips):
    path = os.path.join(tmp_dir, "t")
    trips.write.option("header", "true").csv(path)
    back = read_trips(spark, path, schema=TRIP_SCHEMA)
    assert back.count() == 8 and back.columns == list(TRIP_COLUMNS)


def test_parquet_scan_with_schema_casts_by_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "p")
    spark.createDataFrame([(1, 2.5, "x")], "date long, trip_length double, extra string").write.parquet(path)
    back = read_trips(spark, path, fmt="parquet", schema=TRIP_SCHEMA)
    row = back.first()
    assert (row["date"], row["trip_length"], row["extra"]) == ("1", "2.5", "x")


def test_export_csv_single_file_with_header(merged, tmp_dir):
    path = os.path.join(tmp_dir, "wait")
    export_csv(A.daily_wait(merged), path, order_by=["day"])
    parts = glob.glob(os.path.join(path, "part-*.csv"))
    assert len(parts) == 1
    with open(parts[0]) as fh:
        assert fh.read().splitlines() == ["day,average_waiting_time", "1,250.0", "2,500.0", "3,7.0", "4,"]


def test_export_csv_overwrites(merged, tmp_dir):
    path = os.path.join(tmp_dir, "wait")
    export_csv(A.daily_wait(merged), path)
    export_csv(A.long_wait_days(A.daily_wait(merged)), path)
    (part,) = glob.glob(os.path.join(path, "part-*.csv"))
    with open(part) as fh:
        assert fh.read().splitlines() == ["day,average_waiting_time", "2,500.0"]


def test_export_csv_writes_one_file_at_any_size_or_one_per_task(spark, tmp_dir):
    df = spark.range(0, 200_000, numPartitions=4).withColumn("k", F.col("id") % 1000)
    one, many = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "many")
    export_csv(df, one, order_by=["k", "id"])
    (part,) = glob.glob(os.path.join(one, "part-*.csv"))
    with open(part) as fh:
        lines = fh.read().splitlines()[1:]
    got = [tuple(map(int, x.split(",")))[::-1] for x in lines]
    assert len(got) == 200_000 and got == sorted(got)
    export_csv(df, many, single_file=False)
    assert len(glob.glob(os.path.join(many, "part-*.csv"))) == 4
    assert spark.read.option("header", "true").csv(many).count() == 200_000


def test_export_csv_computes_its_input_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(1000).mapInArrow(count, "id bigint").groupBy((F.col("id") % 7).alias("k")).count()
    export_csv(df, os.path.join(tmp_dir, "once"), order_by=["k"])
    assert seen.value == 1000


def test_object_store_conf():
    conf = object_store_conf("http://store:9000", "ak", "sk")
    assert conf == {
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.access.key": "ak",
        "spark.hadoop.fs.s3a.secret.key": "sk",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
    }


def test_scratch_dir_uses_checkpoint_dir(spark):
    assert scratch_dir(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")


def test_pin_session_sets_utc_and_aqe(spark):
    from ridelens.session import PINNED_SQL_CONF, pin_session

    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    pin_session(spark)
    for key, value in PINNED_SQL_CONF.items():
        assert spark.conf.get(key) == value


def test_trips_keep_the_scan_unless_told(spark):
    from ridelens.sources.star import trips_from_star

    from conftest import SF_SMALL, plan_text

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(1 << 30))
    try:
        assert "hashpartitioning" not in plan_text(trips_from_star(spark, SF_SMALL))
        assert "hashpartitioning(l_orderkey" in plan_text(trips_from_star(spark, SF_SMALL, partitions=3))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _exchanged_with(plan, column):
    return sum("Exchange" in block.split("\n")[0] and column in block for block in plan.split("\n\n"))


def test_line_items_are_shuffled_once_at_any_size_of_the_dimensions(spark):
    from ridelens.sources import star

    from conftest import SF_SMALL, plan_text

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(star.trips_from_star(spark, SF_SMALL, partitions=3))
        assert _exchanged_with(plan, "l_extendedprice") == 1
        supplier = star._table(spark, SF_SMALL, "supplier").select("s_suppkey")
        few, many = (star._sent(supplier, supplier.count() - k) for k in (0, 1))
        assert "BroadcastHashJoin" in plan_text(supplier.join(few, "s_suppkey"))
        assert "Broadcast" not in plan_text(supplier.join(many, "s_suppkey"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_trips_of_repeated_and_missing_keys(spark, tmp_dir):
    from ridelens.sources.star import trips_from_star

    from conftest import rows

    put = lambda name, rows, cols: spark.createDataFrame(rows, cols).write.parquet(f"{tmp_dir}/{name}.parquet")
    put("customer", [(1, 10), (1, 11), (2, None), (None, 12)], "c_custkey long, c_nationkey int")
    put("orders", [(1, 1, "1-URGENT"), (2, 2, "2-HIGH"), (2, None, None), (None, 1, None), (3, 9, None)], "o_orderkey long, o_custkey long, o_orderpriority string")
    put("supplier", [(5, 7), (5, 8), (None, 9)], "s_suppkey long, s_nationkey int")
    item = lambda order, supplier, line: (order, 1, supplier, line, 2.0, 10.0, 0.1, 0.0, "R", datetime.date(2024, 1, 2))
    put("lineitem", [item(1, 5, 1), item(1, None, 2), item(2, 5, 3), item(None, 5, 4), item(3, 5, 5)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate date")
    for partitions in (None, 3):
        got = rows(trips_from_star(spark, tmp_dir, partitions), "pickup_location", "dropoff_location", "time_of_day")
        assert got == [(p, d, t) for p, t in ((None, "afternoon"), ("10", "evening"), ("11", "evening")) for d in ("07", "8")]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from ridelens.session import _one_machine

    assert all(_one_machine(m) for m in ("local", "local[8]", "local[*]", "local[2,3]"))
    assert not any(_one_machine(m) for m in ("local-cluster[3,2,1024]", "yarn", "k8s://https://x", "spark://h:7077"))

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session())


def test_each_session_gets_a_frame_of_its_own(spark):
    from ridelens.plans.registry import QUERIES

    from conftest import SF_SMALL

    other = spark.newSession()
    for session in (spark, other, spark):
        frame = QUERIES["merge_zones"](session, SF_SMALL)
        assert frame.sparkSession._jsparkSession.equals(session._jsparkSession)


def test_changed_tables_are_written_anew(spark, tmp_dir):
    import shutil

    import pyarrow.parquet as pq

    from ridelens.sources.star import load_inputs

    from conftest import SF_SMALL

    folder = os.path.join(tmp_dir, "tables")
    os.makedirs(folder)
    for name in ("lineitem", "orders", "customer", "supplier", "nation", "region"):
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", f"{folder}/{name}.parquet")
    first = load_inputs(spark, folder)[0].count()
    pq.write_table(pq.read_table(f"{SF_SMALL}/lineitem.parquet").slice(0, 100), f"{folder}/lineitem.parquet")
    assert (first, load_inputs(spark, folder)[0].count()) == (6000, 100)


def test_store_settings_from_the_environment():
    from ridelens.session import store_conf_from_environment

    env = {"S3_ENDPOINT": "http://store:9000", "S3_ACCESS_KEY": "ak", "S3_SECRET_KEY": "sk"}
    assert store_conf_from_environment(env) == object_store_conf("http://store:9000", "ak", "sk")
    assert store_conf_from_environment({}) == {}
    with pytest.raises(ValueError, match="S3_SECRET_KEY"):
        store_conf_from_environment({"S3_ENDPOINT": "x", "S3_ACCESS_KEY": "y"})


def test_typed_parquet_trips_give_the_same_answers(spark, tmp_dir, trips, zones, merged):
    """A production parquet table carries numeric types; the casts are then
    no-ops or plain widenings and every answer stays the same."""
    from ridelens.operators.zone_merge import enrich
    from ridelens.plans import analyses as A
    from ridelens.plans import series as S

    from conftest import rows

    typed = trips.select(
        "business", "pickup_location", "dropoff_location",
        F.col("trip_length").try_cast("double").alias("trip_length"),
        F.col("request_to_pickup").try_cast("double").try_cast("int").alias("request_to_pickup"),
        F.col("total_ride_time").try_cast("int").alias("total_ride_time"),
        F.col("date").try_cast("bigint").alias("date"),
        "time_of_day",
        F.col("driver_total_pay").try_cast("double").alias("driver_total_pay"),
        F.col("rideshare_profit").try_cast("double").alias("rideshare_profit"),
    )
    path = os.path.join(tmp_dir, "typed")
    typed.write.parquet(path)
    typed_merged = enrich(read_trips(spark, path, fmt="parquet"), zones)
    for build, cols in (
        (A.daily_wait, ["day", "average_waiting_time"]),
        (A.avg_pay_by_time_of_day, ["time_of_day", "average_driver_total_pay"]),
        (A.top_borough_routes, ["Route", "total_profit"]),
        (S.business_month_totals, ["business_month", "trip_count", "total_profit", "total_earnings"]),
    ):
        assert rows(build(typed_merged), *cols) == rows(build(merged), *cols)
    assert rows(typed_merged, "date") == rows(merged, "date")


def test_a_replaced_table_is_seen_by_path_and_by_uri(spark, tmp_dir):
    from ridelens.sources.star import _fingerprint

    for where in (tmp_dir, f"file://{tmp_dir}", f"file:///{tmp_dir}"):
        spark.range(3).write.mode("overwrite").parquet(f"{tmp_dir}/lineitem.parquet")
        before = _fingerprint(spark, where)
        assert _fingerprint(spark, where) == before
        spark.range(5).write.mode("overwrite").parquet(f"{tmp_dir}/lineitem.parquet")
        assert _fingerprint(spark, where) != before


def test_a_table_behind_another_file_system_is_seen(spark, tmp_dir):
    """A URI that only Hadoop resolves."""
    from ridelens.sources.star import _file_states

    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.seen.link./in", f"file://{tmp_dir}")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    states = _file_states(spark, "viewfs://seen/in/orders.parquet")
    assert len(states) == 2 and any(x.startswith("part-") for x in states)  # the part and the success mark
    assert _file_states(spark, "viewfs://seen/in/none.parquet") == []
