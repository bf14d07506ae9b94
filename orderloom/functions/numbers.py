"""Ratios and rounding on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; an empty denominator gives NULL instead of an error."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_double(c: Column, digits: int) -> Column:
    """Round the double itself, half away from zero.

    ``F.round`` looks at the shortest decimal text of the double and would turn
    0.285 (stored a little below) into 0.29; scaling first gives 0.28.
    """
    scale = F.lit(float(10**digits))
    return F.round(c * scale, 0) / scale


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
