"""Rounding, ratios and number parsing shared by every plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers too short to overflow.
SHORT_NUMBER = r"^[+-]?[0-9]{1,15}([.][0-9]{1,15})?$"
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def rounded(value: Column, places: int) -> Column:
    """Round half away from zero on a decimal, so a tie never depends on binary noise."""
    return F.round(value.try_cast("decimal(28,8)"), places).cast("double")


def rate(value: Column) -> Column:
    return rounded(value, 4)


def money(value: Column) -> Column:
    return rounded(value, 2)


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double; null when the denominator is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def half_even(value: Column, places: int = 0) -> Column:
    """Round a double half to even after scaling it."""
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain, finite number becomes null.

    The pattern is needed because a bare cast also accepts ``12d`` and ``NaN``; ``1e400`` overflows to infinity.
    """
    number = text.try_cast("double")
    finite = F.abs(number) < F.lit(float("inf"))
    return F.when(text.rlike(SHORT_NUMBER), number).when(text.rlike(NUMBER_PATTERN) & finite, number)


def floored_at_zero(value: Column) -> Column:
    """max(value, 0) that keeps null (``greatest`` would skip it)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))
