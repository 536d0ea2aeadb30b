"""Score arithmetic (X1), defaults (X6) and the release year."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the release year is the first four digits in round brackets.
YEAR_PATTERN = r"\((\d{4})\)"


def smoothed_score(count: Column, mean: Column, m: float, prior: Column) -> Column:
    """Bayesian average ``n/(n+m) * mean + m/(n+m) * prior``.

    ``try_divide`` gives NULL for n = m = 0, where ANSI division would fail.
    """
    weight = F.lit(m)
    total = count + weight
    return F.try_divide(count, total) * mean + F.try_divide(weight, total) * prior


def falsy_default(value: Column, default: float) -> Column:
    """The value, or the default where it is NULL or zero."""
    return F.coalesce(F.nullif(value, F.lit(0.0)), F.lit(default))


def title_year(title: Column) -> Column:
    """Year of the first ``(dddd)`` in the title, else NULL."""
    return F.nullif(F.regexp_extract(title, YEAR_PATTERN, 1), F.lit("")).cast("int")
