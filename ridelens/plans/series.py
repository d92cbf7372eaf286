"""Chart-ready series. The original draws these on one machine from exported
files; here only the data side is built, as Spark aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.functions.casts import to_float
from ridelens.functions.keys import log10_positive
from ridelens.operators.exact import aggregate_exactly
from ridelens.plans.analyses import WAIT_MONTH, WAIT_THRESHOLD_SECONDS, _business_month_key, daily_wait

SERIES_MEASURES = ("trip_count", "total_profit", "total_earnings")


def business_month_totals(merged: DataFrame) -> DataFrame:
    """``business_month, trip_count, total_profit, total_earnings``, unsorted.
    One scan and one aggregate for what the original computes as three
    separate jobs. Also valid on a streaming DataFrame."""
    sums = {"total_profit": to_float("rideshare_profit"), "total_earnings": to_float("driver_total_pay")}
    return aggregate_exactly(merged, [_business_month_key(merged)], sums=sums, count="trip_count")


def business_month_series(merged: DataFrame) -> DataFrame:
    """:func:`business_month_totals` sorted by the key as text."""
    return business_month_totals(merged).orderBy("business_month")


def business_month_log_series(merged: DataFrame) -> DataFrame:
    """The series on a log scale: ``log_<measure>`` is ``log10`` of the
    measure, null where the measure is zero or negative (loss-making months)."""
    series = business_month_totals(merged)
    return series.select(
        "business_month", *[log10_positive(m).alias(f"log_{m}") for m in SERIES_MEASURES]
    ).orderBy("business_month")


def wait_series_flagged(
    merged: DataFrame, month: int = WAIT_MONTH, threshold: float = WAIT_THRESHOLD_SECONDS
) -> DataFrame:
    """``day, average_waiting_time, over_threshold``; the flag is null when
    the average is null."""
    return daily_wait(merged, month).withColumn(
        "over_threshold", F.col("average_waiting_time") > F.lit(threshold)
    )
