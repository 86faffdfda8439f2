"""Exact decimal quotients with one rounding, half away from zero."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact(value: Column, scale: int = 1) -> Column:
    """A count or a total as a decimal that leaves a quotient 17 or more decimal places."""
    return value.cast(f"decimal({19 + scale},{scale})")


def quotient(num: Column, den: Column, scale: int = 1) -> Column:
    return exact(num, scale) / exact(den)


def rate(num: Column, den: Column, places: int, guard: Column | None = None, scale: int = 1) -> Column:
    """``num / den`` rounded once; NULL unless the guard (by default ``den``) is positive."""
    positive = den if guard is None else guard
    return F.when(positive > 0, F.round(quotient(num, den, scale), places))


def mean(total: Column, n: Column, places: int) -> Column:
    """The mean from a sum and a count.

    ``avg`` over decimals keeps only four more places than its input and would round twice.
    """
    return rate(total, n, places, scale=3)
