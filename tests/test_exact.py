"""Sums that are the same bit for bit in any order, against exact fractions."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ridelens.operators.exact import aggregate_exactly
from ridelens.plans import analyses as A
from ridelens.plans import series as S

from conftest import SF_SMALL, plan_text


def sums_of(spark, values, parts=1, seed=0):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts, F.rand(seed))
    row = aggregate_exactly(df, [F.lit(1).alias("k")], sums={"s": F.col("x")}, means={"m": F.col("x")}, count="n").first()
    return row.s, row.m, row.n


def values_of(kind, rng, n=400):
    return {
        "money": [round(rng.uniform(-50, 200), 2) for _ in range(n)],
        "floats": [struct.unpack("f", struct.pack("f", rng.uniform(-1e4, 1e4)))[0] for _ in range(n)],
        "cancelling": [x for _ in range(n // 2) for v in [rng.uniform(1e10, 1e17)] for x in (v, -v)] + [1e-9],
        "wide": [rng.choice([-1, 1]) * 2.0 ** rng.uniform(-50, 62) for _ in range(n)],
        "negative": [-rng.random() for _ in range(n)],
        "tiny": [2.0**-52, -(2.0**-53), 2.0**-100],
    }[kind]


@pytest.mark.parametrize("kind", ["money", "floats", "cancelling", "wide", "negative", "tiny"])
def test_sums_are_exact_to_the_last_bit_or_one_beside_it(spark, kind):
    values = values_of(kind, random.Random(kind))
    want = sum(map(Fraction, values))
    got = [sums_of(spark, values, parts, parts) for parts in (1, 3, 7)]
    assert len(set(got)) == 1
    total, mean, n = got[0]
    assert n == len(values) and mean == total / n
    assert abs(Fraction(total) - want) <= Fraction(math.ulp(float(want)))


def test_nulls_nan_infinities_and_values_out_of_range(spark):
    inf, nan = math.inf, math.nan
    assert sums_of(spark, [None, None])[:2] == (None, None)
    assert sums_of(spark, [1.5, None])[:2] == (1.5, 1.5)
    assert sums_of(spark, [0.0, -0.0])[0] == 0.0
    assert sums_of(spark, [1.0, inf])[0] == inf and sums_of(spark, [1.0, -inf])[0] == -inf
    assert math.isnan(sums_of(spark, [inf, -inf])[0]) and math.isnan(sums_of(spark, [1.0, nan])[0])
    assert sums_of(spark, [1e300, 1.0])[0] == 1e300 and sums_of(spark, [2.0**63, -(2.0**63), 3.0])[0] == 3.0
    assert sums_of(spark, [1e-300])[0] == 1e-300 and sums_of(spark, [5e-324])[0] == 5e-324


def test_null_keys_columns_with_odd_names_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0), (None, 0.5)], "k string, `x.y` double").withColumnRenamed("k", "the.key")
    rows = aggregate_exactly(df, ["`the.key`"], sums={"x.y": F.col("`x.y`")}, count="n").collect()
    assert sorted(map(tuple, rows), key=str) == [("a", 1, 2.0), (None, 2, 1.5)]
    assert aggregate_exactly(df.limit(0), ["`the.key`"], sums={"s": F.col("`x.y`")}).collect() == []


def test_the_plan_is_one_partial_aggregate_and_parses_text_once(spark, trips):
    plan = plan_text(aggregate_exactly(trips, ["business"], sums={"s": F.col("driver_total_pay").try_cast("double")}))
    assert "partial_sum" in plan and "Python" not in plan
    assert plan.count("try_cast") + plan.count("cast(driver_total_pay") <= 4


ANALYSES = {
    "profit": A.monthly_profit, "earnings": A.monthly_earnings, "routes": A.top_borough_routes, "pay": A.avg_pay_by_time_of_day,
    "length": A.avg_length_by_time_of_day, "ratio": A.earning_per_mile, "joined": A.join_two_aggregates, "all": A.time_of_day_averages, "series": S.business_month_totals,
}


@pytest.mark.parametrize("name", ANALYSES)
def test_analyses_do_not_depend_on_how_trips_are_dealt(spark, name):
    from ridelens.operators.zone_merge import enrich
    from ridelens.sources.star import load_inputs

    trips, zones = load_inputs(spark, SF_SMALL)
    dealt = [trips, trips.repartition(13, F.rand(1)), trips.repartition(3, F.rand(2)).sortWithinPartitions(F.rand(3))]
    got = [sorted(map(str, ANALYSES[name](enrich(t, zones)).collect())) for t in dealt]
    assert got[0] == got[1] == got[2] and got[0]
