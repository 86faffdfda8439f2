"""Text and floating-point values to typed columns; what cannot be read becomes NULL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def safe_int(value: Column) -> Column:
    """Whole numbers written as text; empty or other text is NULL."""
    return value.cast("string").try_cast("int")


def safe_numeric(value: Column, kind: str) -> Column:
    """Numbers written as text (".301"); placeholders such as ".---" are NULL."""
    return value.cast("string").try_cast(kind)


def missing_to_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def truthy_or(value: Column, fallback: Column) -> Column:
    """The value unless it is NULL or zero."""
    return F.coalesce(F.nullif(value, F.lit(0)), fallback)


def measured(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """A measurement that may come as text or as a float with NaN for missing.

    Whole-number targets drop the fraction (3.0 is 3), as the values reach us as floats.
    """
    if isinstance(source, T.StringType):
        # Text without a digit is no number, NaN or infinite, and NULL in any case; trying it costs an exception.
        value = F.when(value.rlike("[0-9]"), value).try_cast("double")
    if isinstance(source, (T.StringType, T.FloatType, T.DoubleType)):
        # One use of the value, so that a text is read once.
        value = F.nanvl(value, F.lit(None).cast("double"))
        if isinstance(target, T.DecimalType) and isinstance(source, T.DoubleType):
            return _decimal(value, target)
    return value.try_cast(target)


def _decimal(value: Column, target: T.DecimalType) -> Column:
    """A double as a decimal, half away from zero, as a cast gives it.

    A cast goes by the digits of the double, the dearest step of reading pitches. A double that is the nearest
    to a number of the target's places, as measurements are, is that number: any digits that
    stand for the double lie closer to it than half a place if it has at most 15 digits. Others are cast.
    """
    unit = F.lit(float(10**target.scale))
    n = F.rint(value * unit)
    written = (F.abs(n) < F.lit(float(10 ** min(target.precision, 15)))) & (n / unit == value)
    whole = n.cast("long").cast(T.DecimalType(target.precision, 0))
    scaled = (whole * F.lit(Decimal(1).scaleb(-target.scale)) if target.scale else whole).cast(target)
    return F.when(written, scaled).otherwise(value.try_cast(target))


def calendar_day(value: Column) -> Column:
    """The date part of a date, a timestamp or text that starts with an ISO date."""
    return F.substring(value.cast("string"), 1, 10).try_cast("date")
