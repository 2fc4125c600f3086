"""Arithmetic that is safe under ANSI mode and, where asked, exact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import as_column

MIN_DENOMINATOR = 1e-8


def exact_sum(value: Column | str, scale: int | None, precision: int = 18) -> Column:
    """``sum`` as double; with ``scale`` the addition runs in decimal.

    Decimal addition is associative, so the result does not depend on how the rows were
    split, merged or retried. Values of up to 18 digits are kept in longs before they are added; a larger
    ``precision`` is for values that need it. ``scale=None`` is the floating-point sum.
    """
    value = as_column(value)
    if scale is None:
        return F.sum(value)
    return F.sum(value.cast(f"decimal({precision},{scale})")).cast("double")


def out_of_range(value: Column | str, scale: int, precision: int = 18) -> Column:
    """Number of values an exact sum can't hold: they would fail it, and none is left out in silence."""
    value = as_column(value)
    return F.count_if(value.isNotNull() & value.try_cast(f"decimal({precision},{scale})").isNull())


def exact_mean(value: Column | str, scale: int | None, precision: int = 18) -> Column:
    """Mean of the non-null values; with ``scale`` built on :func:`exact_sum`."""
    value = as_column(value)
    if scale is None:
        return F.avg(value)
    return F.try_divide(exact_sum(value, scale, precision), F.count(value).cast("double"))


def pct_change(start: Column | str, end: Column | str) -> Column:
    """Relative change in percent; NULL when the start is zero."""
    start, end = as_column(start), as_column(end)
    return F.try_divide(end - start, start) * F.lit(100.0)


def clip_lower(value: Column | str, floor: float = MIN_DENOMINATOR) -> Column:
    """Values below ``floor`` become ``floor``; NULL stays NULL."""
    value = as_column(value)
    return F.when(value < floor, F.lit(floor)).otherwise(value)


def pct_error(actual: Column | str, predicted: Column | str) -> Column:
    """Absolute error in percent of the (floored) actual value."""
    actual, predicted = as_column(actual), as_column(predicted)
    return F.abs(actual - predicted) / clip_lower(actual) * F.lit(100.0)
