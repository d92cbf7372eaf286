"""Column expressions and the null / cast / time-zone rules they pin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridelens.functions import (
    borough_route,
    business_month,
    day_of,
    epoch_to_date,
    log10_positive,
    month_of,
    to_double,
    to_float,
    to_int_truncating,
    year_of,
    zone_route,
)


def _one(spark, expr, data, schema="a string, b string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_epoch_to_date_utc(spark, trips):
    # session zone pinned to UTC: midnight epochs map to their own day
    got = [r[0] for r in trips.select(epoch_to_date("date")).collect()]
    assert got == [
        "2023-01-01", "2023-01-01", "2023-01-02", "2024-01-01",
        "2023-02-01", "2023-02-01", "2023-01-03", "2023-01-04",
    ]


def test_epoch_to_date_depends_on_session_zone(spark):
    df = spark.createDataFrame([("1672531200",)], "date string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert df.select(epoch_to_date("date")).first()[0] == "2022-12-31"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert df.select(epoch_to_date("date")).first()[0] == "2023-01-01"


def test_bad_epoch_is_null(spark):
    assert _one(spark, epoch_to_date("a"), [("x", None), (None, None)]) == [None, None]


def test_date_parts(spark):
    df = spark.createDataFrame([("2024-01-31",), ("bad",)], "date string")
    got = df.select(year_of("date"), month_of("date"), day_of("date")).collect()
    assert tuple(got[0]) == (2024, 1, 31)
    assert tuple(got[1]) == (None, None, None)


def test_casts_bad_text_is_null(spark):
    data = [("2.5", None), ("bad", None), (None, None)]
    assert _one(spark, to_double("a"), data) == [2.5, None, None]
    assert _one(spark, to_float("a"), data) == [2.5, None, None]


def test_int_cast_truncates_fraction(spark):
    # the legacy string -> int cast truncated; try_cast alone would give null
    data = [("301.7", None), ("7", None), ("-2.9", None), ("bad", None), ("1e20", None)]
    assert _one(spark, to_int_truncating("a"), data) == [301, 7, -2, None, None]


def test_float_rounding_before_sum(spark):
    # 0.3 as float is 0.30000001192092896
    assert _one(spark, to_float("a").cast("double"), [("0.3", None)]) == [0.30000001192092896]


def test_concat_ws_keys_skip_nulls(spark):
    data = [("Uber", "3"), (None, "2"), ("Lyft", None)]
    assert _one(spark, business_month("a", "b"), data) == ["Uber-3", "2", "Lyft"]
    data = [("Brooklyn", "Queens"), ("Brooklyn", None), (None, None)]
    assert _one(spark, borough_route("a", "b"), data) == ["Brooklyn to Queens", "Brooklyn", ""]


def test_zone_route_null_if_any_null(spark):
    data = [("A", "B"), ("A", None), (None, "B")]
    assert _one(spark, zone_route("a", "b"), data) == ["A to B", None, None]


def test_log10_positive(spark):
    df = spark.createDataFrame([(100.0,), (0.0,), (-5.0,), (None,)], "x double")
    assert [r[0] for r in df.select(log10_positive(F.col("x"))).collect()] == [2.0, None, None, None]
