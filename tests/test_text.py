import datetime as dt
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry_spark.functions import dates, measures, rules, text


def test_double_rejects_what_is_not_a_number(values):
    inputs = ["1.5", " -6.25\t", ".5", "3.", "1e3", "12,5", "1.5d", "NaN", "", None, "abc", "0x1A"]
    assert values(inputs, text.to_double) == [1.5, -6.25, 0.5, 3.0, 1000.0, *[None] * 7]


def test_double_of_infinity_and_of_nan(values, frame):
    assert values(["Inf", "-inf"], text.to_double) == [math.inf, -math.inf]
    df = frame([(float("nan"),), (2.0,), (None,)], "x double")
    out = [r[0] for r in df.select(text.to_double(F.col("x"), T.DoubleType())).collect()]
    assert out == [None, 2.0, None]


def test_integer_truncates_and_overflows_to_null(values):
    assert values(["12.7", "-12.7", "3e9", "100000", "x", None], text.to_integer) == [12, -12, None, 100000, None, None]


def test_boolean_text_has_no_null(values):
    inputs = ["yes", "Y", "1", "true", "TRUE", "no", "0", "", None]
    assert values(inputs, text.to_boolean) == [True] * 5 + [False] * 4


def test_boolean_column_keeps_null(frame):
    df = frame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in df.select(text.to_boolean(F.col("b"), T.BooleanType())).collect()] == [True, False, None]


def test_date_is_strict(values):
    inputs = ["2024-01-05", "2024-1-5", "2024/01/05", "2024-01-05x", "2024-02-30", "junk", None]
    day = dt.date(2024, 1, 5)
    assert values(inputs, text.to_date) == [day, day, day, None, None, None, None]


def test_trim_and_squish(values):
    assert values(["\t a b \r\n", " x"], text.trim_ws) == ["a b", " x"]
    assert values(["  a \t\n b  c ", "   ", ""], text.squish) == ["a b c", "", ""]


def test_open_dates(values):
    inputs = ["12apr2025", "1apr2025", "12APR2025", "2024-01-05", "2024-1-5", "2024-01-05T10:11:12",
              "01jan1970", "1970-01-01", "1850-06-01", "2024-02-30", "12apr2025x", "junk", None]
    day = dt.date(2025, 4, 12)
    new_year = dt.date(2024, 1, 5)
    assert values(inputs, dates.parse_open_date) == [
        day, dt.date(2025, 4, 1), day, new_year, new_year, new_year,
        None, None, dt.date(1850, 6, 1), None, None, None, None,
    ]
    assert values(["01jan1970"], lambda c: dates.parse_open_date(c, None)) == [dt.date(1970, 1, 1)]


def test_plausible_year(values):
    inputs = ["1899-12-31", "1900-01-01", "2024-06-01", "2025-01-01"]
    out = values(inputs, lambda c: dates.plausible_year(F.to_date(c), F.lit(2024)))
    assert out == [None, 1900, 2024, None]


def test_date_of_iso_datetime(values):
    assert values(["2026-05-20T01:02:03Z", "2026-05-20", "T", None], dates.date_of_iso_datetime) == [
        dt.date(2026, 5, 20), dt.date(2026, 5, 20), None, None]


def test_first_match_takes_the_earlier_rule(values):
    table = [("ent\\b", "ear"), ("management|art\\b", "other")]
    out = values(["Waste management", "open heart", "nothing", None, "moment"],
                 lambda c: rules.first_match(F.lower(c), table, "none"))
    assert out == ["ear", "other", "none", "none", "ear"]


def test_word_boundary_follows_unicode_letters(values):
    out = values(["présent", "ententé", "ent é"], lambda c: rules.matches(F.lower(c), "ent\\b"))
    assert out == [True, False, True]


def test_percent_of_nothing_is_null(frame):
    df = frame([(0, 0), (1, 8), (1, 400)], "a int, b int")
    out = df.select(measures.percent_half_even(F.col("a"), F.col("b")),
                    measures.percent_half_up(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in out] == [(None, None), (12.5, 12.5), (0.2, 0.3)]
