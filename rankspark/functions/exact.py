"""Sums of doubles that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Bits of a fractional part, and how many parts are kept: values are cut 2**-90 below the unit.
_BITS, _PARTS = 30, 3


def exact_sum(value: Column) -> Column:
    """Sum of doubles below 2**63, the same bit by bit however the rows are dealt out.

    A value is split into its whole part and fractional parts of 30 bits, all of them whole
    numbers, which add up without rounding; the sums are put together once, at the end.  Bits
    below 2**-90 are cut off each value.  A NaN or an infinite value makes the sum what a plain
    sum would be; no value at all makes it NULL.
    """
    finite = F.when(F.abs(value) < float("inf"), value)
    whole = F.floor(finite)
    sums, rest = [_sum(whole)], finite - whole
    for _ in range(_PARTS):
        rest = rest * F.lit(float(1 << _BITS))
        part = F.floor(rest)
        sums.append(_sum(part))
        rest = rest - part
    total = sums[-1]
    for part in reversed(sums[:-1]):
        total = part + total / F.lit(float(1 << _BITS))
    plain = F.sum(F.when(F.isnan(value) | (F.abs(value) == float("inf")), value))
    return F.coalesce(plain, total)


def exact_mean(value: Column) -> Column:
    return F.try_divide(exact_sum(value), F.count(value))


def _sum(part: Column) -> Column:
    return F.sum(part.cast("decimal(20,0)")).cast("double")
