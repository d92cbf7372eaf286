"""Date handling.

Trips carry the date as epoch seconds. The merge step replaces it with a
``yyyy-MM-dd`` string in the session time zone (pinned to UTC by
``ridelens.session``). Date parts are read back from that string; parsing an
ISO date is a cheap fixed-format parse, and a malformed value gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelens.functions.casts import _col, to_epoch_seconds

# Fixed value: the output format of the converted date.
DATE_FORMAT = "yyyy-MM-dd"


def epoch_to_date(c: str | Column) -> Column:
    """Epoch seconds (text or number) -> ``yyyy-MM-dd`` string."""
    return F.from_unixtime(to_epoch_seconds(c), DATE_FORMAT)


def as_date(c: str | Column) -> Column:
    """``yyyy-MM-dd`` string -> DateType, null when it does not parse."""
    return _col(c).try_cast("date")


def year_of(c: str | Column) -> Column:
    return F.year(as_date(c))


def month_of(c: str | Column) -> Column:
    """Month 1..12 of a date string. No year: January 2023 and January 2024
    are the same month here, as in every monthly analysis."""
    return F.month(as_date(c))


def day_of(c: str | Column) -> Column:
    """Day of month 1..31 of a date string."""
    return F.dayofmonth(as_date(c))
