"""Row filters. All are plain column predicates, so Catalyst pushes them below
the zone joins to the trip scan (and into the lookup scan for zone columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.functions.dates import month_of


def in_month(df: DataFrame, month: int, date_col: str = "date") -> DataFrame:
    """Rows whose ``yyyy-MM-dd`` date falls in ``month`` of any year."""
    return df.filter(month_of(date_col) == F.lit(month))


def equals(df: DataFrame, column: str, value: str) -> DataFrame:
    """Case-sensitive equality; null rows drop."""
    return df.filter(F.col(column) == F.lit(value))


def between_places(
    df: DataFrame,
    pickup: str,
    dropoff: str,
    pickup_col: str = "Pickup_Borough",
    dropoff_col: str = "Dropoff_Borough",
) -> DataFrame:
    """Trips from ``pickup`` to ``dropoff``."""
    return df.filter((F.col(pickup_col) == F.lit(pickup)) & (F.col(dropoff_col) == F.lit(dropoff)))
