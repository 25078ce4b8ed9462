"""Mixed-format opening dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = dt.date(1970, 1, 1)
FIRST_PLAUSIBLE_YEAR = 1900


def parse_open_date(raw: Column, sentinel: dt.date | None = EPOCH) -> Column:
    """``12apr2025`` first, then the first ten characters as ``2025-04-12``.

    ``sentinel`` is the date a source writes for "unknown"; it becomes NULL.
    """
    text = raw.cast("string")
    parsed = F.coalesce(
        F.try_to_date(text, "dMMMyyyy"),
        F.try_to_date(F.substring(text, 1, 10), "yyyy-M-d"),
    )
    return parsed if sentinel is None else F.nullif(parsed, F.lit(sentinel))


def plausible_year(date: Column, current_year: Column | int) -> Column:
    """Year of ``date``, NULL before 1900 or after ``current_year``."""
    year = F.year(date)
    return F.when(year.between(F.lit(FIRST_PLAUSIBLE_YEAR), current_year), year)


def date_of_iso_datetime(text: Column) -> Column:
    """Date part of an ISO date-time: everything from ``T`` on is cut."""
    return F.try_to_date(F.regexp_replace(text, "T.*", ""), "yyyy-MM-dd")
