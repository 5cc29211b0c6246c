"""Number helpers with the missing-value rules the jobs need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """A quotient that is NULL, not an error, when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """A quotient where nothing over nothing counts as zero, as in F1 scores."""
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def round_half_even(column: Column, digits: int = 2) -> Column:
    return F.bround(column, digits)


def relative_change(current: Column, previous: Column) -> Column:
    return ratio(current, previous) - F.lit(1.0)
