"""Ranking, top-K per group and global top-N.

These always run on aggregated rows (one per borough x month, one per
route), never on raw trips, so the window's partition is bounded by the
number of groups and not by the number of trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _names(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def rank_within(
    df: DataFrame,
    partition: str | Sequence[str],
    by: str,
    name: str = "rank",
    descending: bool = True,
) -> DataFrame:
    """Competition rank (ties share a rank, the next rank skips) of ``by``
    inside each partition."""
    order = F.desc(by) if descending else F.asc(by)
    spec = Window.partitionBy(*_names(partition)).orderBy(order)
    return df.withColumn(name, F.rank().over(spec))


def top_k_per_group(
    df: DataFrame,
    partition: str | Sequence[str],
    by: str,
    k: int,
    tiebreak: str | Sequence[str] | None = None,
    rank_name: str = "rank",
) -> DataFrame:
    """Rows ranked ``<= k`` by ``by`` (descending) within each partition,
    sorted by partition, rank, then ``tiebreak``.

    Ties at the cut are all kept, so a group can return more than ``k`` rows.
    Catalyst turns rank + filter into a WindowGroupLimit on both sides of the
    window's exchange, so only ``k``-ish rows per partition are shuffled. The
    partial limit cannot cut ties, so feed this aggregated rows (as the
    analyses do), not raw rows where one huge group shares one value.
    """
    ranked = rank_within(df, partition, by, rank_name)
    order = [F.asc_nulls_first(c) for c in _names(partition)] + [F.col(rank_name)]
    order += [F.asc_nulls_first(c) for c in _names(tiebreak)]
    return ranked.filter(F.col(rank_name) <= k).orderBy(*order)


def top_n(
    df: DataFrame,
    by: str,
    n: int,
    tiebreak: str | Sequence[str] | None = None,
) -> DataFrame:
    """The ``n`` rows with the largest ``by`` (nulls last). Ties at the cut
    are broken by ``tiebreak`` ascending, nulls first, so the answer is the
    same on every run. Planned as TakeOrderedAndProject: each task keeps its
    own top ``n`` and only those are merged, no full sort."""
    order: list[Column] = [F.desc_nulls_last(by)] + [F.asc_nulls_first(c) for c in _names(tiebreak)]
    return df.orderBy(*order).limit(n)
