"""Casts for all-string trip columns.

Spark 4 runs with ANSI on, where a plain ``cast`` of bad text raises. The
original jobs ran with ANSI off, where bad text became null. ``try_cast``
gives the null-on-bad-text rule under both settings, inside codegen.

The old text -> integer cast also took a number with a fraction and dropped the
fraction (``'301.7'`` -> 301, ``'.5'`` -> 0), but no exponent and no suffix.
``try_cast`` gives null for a fraction, so a second step handles those.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    """Money and miles: text -> double, bad text -> null."""
    return _col(c).try_cast("double")


def to_float(c: str | Column) -> Column:
    """32-bit rounding of each value, as the monthly money sums do."""
    return _col(c).try_cast("float")


# Text that the old integer cast took: a sign, digits and a fraction (either
# may be missing, not both marks), between blanks or control characters.
_WHOLE = r"^[\x00-\x20\x7F]*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]*)[\x00-\x20\x7F]*\z"
_INTEGER = r"^[\x00-\x20\x7F]*([+-]?[0-9]*)"


def _truncating(c: str | Column, kind: str) -> Column:
    value = _col(c)
    text = value.cast("string")
    digits = F.regexp_extract(text, _INTEGER, 1)
    whole = F.when(digits.isin("", "+", "-"), F.lit(0).cast(kind)).otherwise(digits.try_cast(kind))
    slow = F.when((F.typeof(value) == "string") & text.rlike(_WHOLE), whole)
    return F.coalesce(value.try_cast(kind), slow)


def to_int_truncating(c: str | Column) -> Column:
    """Seconds: text -> int, a fraction dropped, bad or out-of-range text ->
    null. Numbers truncate toward zero."""
    return _truncating(c, "int")


def to_epoch_seconds(c: str | Column) -> Column:
    """Epoch text -> bigint seconds, by the same rules."""
    return _truncating(c, "bigint")
