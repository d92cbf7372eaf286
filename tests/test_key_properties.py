"""Property tests: the key builders and casts against plain-Python models,
on random batches of rows (nulls, empty strings, odd numbers included)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ridelens.functions import borough_route, business_month, to_epoch_seconds, to_int_truncating, zone_route

TEXT = st.one_of(st.none(), st.text(alphabet="ABab -1", max_size=6))
PAIRS = st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=40)
NUMBERS = st.one_of(
    st.none(),
    st.integers(min_value=-10**6, max_value=10**6).map(str),
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda f: f"{f:.3f}"),
    st.sampled_from(
        ["bad", "", "1e3", " 7", "12d", ".5", "-.5", ".", "-", "+.", "5.", "5.a", "5.5.5", "\t7\n", "1 2", "007", "0x1"]
        + ["2147483648", "-2147483648.9", "9223372036854775807.5", "9223372036854775808", "1672531200.5", "7\u00a0"]
    ),
)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _skip_nulls(sep, a, b):
    return sep.join(x for x in (a, b) if x is not None)


def _null_if_any(sep, a, b):
    return None if a is None or b is None else f"{a}{sep}{b}"


@SETTINGS
@given(PAIRS)
def test_key_builders_match_models(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(
        business_month("a", "b").alias("bm"),
        borough_route("a", "b").alias("br"),
        zone_route("a", "b").alias("zr"),
    ).collect()
    for (a, b), row in zip(pairs, got):
        assert row["bm"] == _skip_nulls("-", a, b)
        assert row["br"] == _skip_nulls(" to ", a, b)
        assert row["zr"] == _null_if_any(" to ", a, b)


@SETTINGS
@given(st.lists(NUMBERS, min_size=1, max_size=40))
def test_integer_casts_match_the_cast_without_ansi(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    got = [tuple(r) for r in df.select(to_int_truncating("a"), to_epoch_seconds("a")).collect()]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = [tuple(r) for r in df.selectExpr("CAST(a AS INT)", "CAST(a AS BIGINT)").collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert got == want
