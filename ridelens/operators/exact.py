"""Sums of doubles that do not depend on the order of the rows.

Floating-point addition rounds after every step, so a plain ``sum`` changes in
its last digits with the number of tasks, or when one is run again. Here each
value is split, without rounding, into eight integers of 21 bits that stand for
fixed powers of two; integers add up exactly in any order; only the finished
group is joined into one double. The group's partial rows hold the eight sums,
so the exchange still carries one row per group and task.

Exact are values below 2^63 in size, down to bits of 2^-105, and 2^42 rows of
a group. What a value has beyond that (and NaN or an infinity as a whole) is
added the plain way, so NaN and infinities come out as they always did.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 21
_MASK = (1 << _BITS) - 1
#: Powers of two of the eight parts: 42, 21, 0, -21, ... -105.
_TOP = 42


def _parts(x: Column, small: Column) -> tuple[list[Column], Column]:
    """The eight integers of ``small`` (``x``, or 0 where that is out of range),
    highest first, and what they leave of ``x``."""
    high = (small * F.lit(2.0**-_BITS)).cast("bigint")
    low = small - high.cast("double") * F.lit(2.0**_BITS)
    middle = (low * F.lit(2.0**42)).cast("bigint")
    fraction = low * F.lit(2.0**42) - middle.cast("double")
    end = (fraction * F.lit(2.0**63)).cast("bigint")
    left = (fraction * F.lit(2.0**63) - end.cast("double")) * F.lit(2.0**-105)
    mask = F.lit(_MASK)
    parts = [F.shiftright(high, _BITS), high.bitwiseAND(mask)]
    for whole in (middle, end):
        parts += [F.shiftright(whole, 2 * _BITS), F.shiftright(whole, _BITS).bitwiseAND(mask), whole.bitwiseAND(mask)]
    return parts, left + (x - small)


def _joined(sums: Sequence[Column]) -> Column:
    """The double of eight sums (highest first): carries go up first, then the
    parts, all of one sign by then, are added from the smallest on."""

    def walk(parts: Sequence[Column]) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.lit(0.0).alias("total"), F.lit(2.0**-105).alias("unit"))

        def step(acc: Column, part: Column) -> Column:
            whole = part + acc["carry"]
            total = acc["total"] + whole.bitwiseAND(F.lit(_MASK)).cast("double") * acc["unit"]
            return F.struct(F.shiftright(whole, _BITS).alias("carry"), total.alias("total"), (acc["unit"] * F.lit(2.0**_BITS)).alias("unit"))

        return F.aggregate(F.array(*reversed(parts)), start, step)

    def value(end: Column) -> Column:
        return end["total"] + end["carry"].cast("double") * end["unit"]

    up, down = walk(sums), walk([-s for s in sums])
    return F.when(up["carry"] >= 0, value(up)).otherwise(-value(down))


def aggregate_exactly(
    df: DataFrame,
    keys: Sequence[str | Column],
    sums: Mapping[str, Column] | None = None,
    means: Mapping[str, Column] | None = None,
    count: str | None = None,
) -> DataFrame:
    """``keys``, then ``count`` (rows, if named), a sum and then a mean per
    named column, the same bit for bit however the rows are dealt over tasks.

    Nulls are skipped; a group without any value has a null sum and mean; null
    keys are a group. A value that is no double is cast to one."""
    named = {**(sums or {}), **(means or {})}
    values = [(F.col(c) if isinstance(c, str) else c).cast("double").alias(f"_x{i}") for i, c in enumerate(named.values())]
    rows = df.select(*keys, *values)
    key_names = rows.columns[: len(keys)]
    outs = [F.count(F.lit(1)).alias(count)] if count else []
    for i, name in enumerate(named):
        x = F.col(f"_x{i}")
        small = F.when(F.abs(x) < F.lit(2.0**63), x).otherwise(F.lit(0.0))
        parts, left = _parts(x, small)
        # An infinity less itself would be NaN: such a value is all left over.
        left = F.when(F.abs(x) < F.lit(2.0**63), left).otherwise(x)
        total = _joined([F.sum(F.when(x.isNotNull(), p)) for p in parts]) + F.sum(left)
        n = F.count(x)
        outs.append(F.when(n > 0, total if sums and name in sums else total / n).alias(name))
    return rows.groupBy(*[F.col(f"`{k}`") for k in key_names]).agg(*outs)
