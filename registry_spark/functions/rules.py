"""Ordered pattern rules as one ``CASE`` expression."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN = re.compile(r"[a-z0-9 ,/&-]+")


def matches(lowered: Column, pattern: str) -> Column:
    """Pattern occurs anywhere in lower-case text; NULL text does not match.

    ``pattern`` is lower case, with alternatives on the top level only. Plain
    alternatives become substring searches, which are cheaper on long texts than a
    regular expression; the rest stay one expression.
    """
    alternatives = pattern.split("|")
    tests = [lowered.contains(a) for a in alternatives if PLAIN.fullmatch(a)]
    regex = "|".join(a for a in alternatives if not PLAIN.fullmatch(a))
    if regex:
        # Word boundaries follow Unicode letters, whatever the Java version.
        tests.append(lowered.rlike("(?U)" + regex))
    return F.coalesce(reduce(lambda x, y: x | y, tests), F.lit(False))


def first_match(lowered: Column, rules: Iterable[tuple[str, object]], default: object) -> Column:
    """Value of the first rule whose pattern occurs in ``lowered``, else ``default``.

    Values may be Python literals or Columns (structs for several attributes at
    once). Rules are tried in the given order and only until one matches. Give a
    column that holds the lower-case text: ``lower(...)`` itself would be evaluated
    again for every alternative.
    """
    case = None
    for pattern, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        hit = matches(lowered, pattern)
        case = F.when(hit, value) if case is None else case.when(hit, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if case is None else case.otherwise(default)
