"""Composite grouping keys.

Two different null rules are in play and both are kept on purpose:

* ``business_month`` and ``borough_route`` join their parts with
  ``concat_ws``, which skips null parts: an unmatched dropoff gives the route
  ``"Brooklyn"``, both unmatched give ``""``, a null business gives ``"2"``.
* ``zone_route`` uses ``concat``, which is null as soon as one part is null;
  all such trips fall into one null route.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelens.functions.casts import _col

# Key separators.
BUSINESS_MONTH_SEPARATOR = "-"
ROUTE_SEPARATOR = " to "


def business_month(business: str | Column, month: str | Column) -> Column:
    """``"Uber-3"``; null parts are skipped."""
    return F.concat_ws(BUSINESS_MONTH_SEPARATOR, _col(business), _col(month))


def borough_route(pickup: str | Column, dropoff: str | Column) -> Column:
    """``"Brooklyn to Queens"``; null parts are skipped."""
    return F.concat_ws(ROUTE_SEPARATOR, _col(pickup), _col(dropoff))


def zone_route(pickup: str | Column, dropoff: str | Column) -> Column:
    """``"A to B"``; null if either side is null."""
    return F.concat(_col(pickup), F.lit(ROUTE_SEPARATOR), _col(dropoff))


def log10_positive(c: str | Column) -> Column:
    """``log10(x)`` for ``x > 0``, else null (a log axis has no place for
    zero or negative totals)."""
    x = _col(c)
    return F.when(x > 0, F.log10(x))
