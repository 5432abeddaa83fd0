"""Guarded arithmetic (ANSI mode raises on division by zero)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_zero(numerator, denominator) -> Column:
    """``numerator / denominator``; 0 when the denominator is not positive, null when it is null."""
    numerator, denominator = _column(numerator), _column(denominator)
    return F.when(denominator > 0, F.try_divide(numerator, denominator)).when(
        denominator.isNotNull(), F.lit(0.0)
    )


def mean_or_zero(total, count) -> Column:
    """Arithmetic mean of a list given its sum and length; 0 for an empty list."""
    return F.coalesce(F.try_divide(_column(total), _column(count)), F.lit(0.0))


def percent_of(part, whole, digits: int = 2) -> Column:
    """Share in percent, rounded; null when the whole is 0."""
    return F.round(F.try_divide(_column(part), _column(whole)) * 100, digits)


def one_decimal(value) -> Column:
    """A number from 0 up, as text with one decimal, rounded by its exact binary value.

    ``format_string`` rounds the shortest decimal form instead: it makes 14.5 of 14.45, although
    that double lies below 14.45. Ties are told by the error of ``value * 100``, which the two
    halves of the double give exactly.
    """
    value = _column(value)
    high = value.cast("float").cast("double")
    low = value - high
    cents = F.rint(value * 100)
    error = (high * 100 - cents) + low * 100
    down = F.floor(cents / 10)
    halfway = cents % 10 == 5
    tenths = (
        F.when(halfway & (error > 0), down + 1)
        .when(halfway & (error < 0), down)
        .when(halfway, down + down % 2)
        .otherwise(F.rint(cents / 10).cast("bigint"))
    )
    return F.format_string("%.1f", tenths / 10)


def progress_percent(current, total) -> Column:
    """Share of the work that is done, in percent; 0 as long as the total is not positive."""
    current, total = _column(current), _column(total)
    return F.when(total > 0, F.try_divide(current, total) * 100).otherwise(F.lit(0.0))


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
