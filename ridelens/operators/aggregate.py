"""Grouped aggregates.

Every aggregate here is algebraic (count, sum, sum/count), so Spark runs it
as partial aggregation in each scan task, a hash exchange of one row per
group per task, and a final merge. A group holding a third of all trips costs
the same shuffle as any other group: one partial row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeyLike = str | Column


def _keys(keys: KeyLike | Sequence[KeyLike]) -> list[KeyLike]:
    if isinstance(keys, (str, Column)):
        return [keys]
    return list(keys)


def count_by(df: DataFrame, keys: KeyLike | Sequence[KeyLike], name: str = "trip_count") -> DataFrame:
    """Rows per group; a null key is its own group."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def count_between(
    df: DataFrame,
    keys: KeyLike | Sequence[KeyLike],
    lower: int = 0,
    upper: int = 1000,
    name: str = "trip_count",
) -> DataFrame:
    """Groups whose row count lies strictly between ``lower`` and ``upper``.
    The filter runs on the final aggregate (a HAVING)."""
    counted = count_by(df, keys, name)
    return counted.filter((F.col(name) > lower) & (F.col(name) < upper))


def count_by_category(
    df: DataFrame,
    keys: KeyLike | Sequence[KeyLike],
    category: KeyLike,
    columns: Mapping[str, str],
    total: str | None = "total_count",
) -> DataFrame:
    """One count column per named category value, in one pass.

    ``columns`` maps output name -> category value. Rows of any other value,
    or a null category, count 0 everywhere but still make their group appear.
    ``total`` (if given) is the sum of the named columns.
    """
    cat = F.col(category) if isinstance(category, str) else category
    aggs = [F.sum(F.when(cat == F.lit(value), 1).otherwise(0)).alias(name) for name, value in columns.items()]
    out = df.groupBy(*_keys(keys)).agg(*aggs)
    if total:
        summed = None
        for name in columns:
            summed = F.col(name) if summed is None else summed + F.col(name)
        out = out.withColumn(total, summed)
    return out


def mean_by_sum_count(
    df: DataFrame,
    keys: KeyLike | Sequence[KeyLike],
    value: KeyLike,
    name: str,
) -> DataFrame:
    """``sum(value) / count(value)`` per group. ``count`` skips nulls, so this
    is the average of the non-null values; a group with no non-null value
    keeps its row with a null mean instead of dividing by zero."""
    v = F.col(value) if isinstance(value, str) else value
    return (
        df.groupBy(*_keys(keys))
        .agg(F.sum(v).alias("_total"), F.count(v).alias("_n"))
        .withColumn(name, F.try_divide(F.col("_total"), F.col("_n")))
        .drop("_total", "_n")
    )
