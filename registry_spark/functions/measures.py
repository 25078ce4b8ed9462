"""Shares and roundings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` in double; NULL when ``whole`` is zero."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def percent_half_even(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.bround(percent(part, whole), digits)


def percent_half_up(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(percent(part, whole), digits)


def count_true(c: Column) -> Column:
    """Rows where ``c`` is TRUE, 0 on an empty input."""
    return F.count(F.when(c, F.lit(1)))
