"""Text clean-up and text-to-type coercion, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers as the registries write them; rejects Java-only spellings such as "1.5d".
NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"

TRUE_WORDS = ("TRUE", "YES", "1", "Y")


def trim_ws(c: Column) -> Column:
    """Trim spaces, tabs, carriage returns and line feeds."""
    return F.btrim(c, F.lit(" \t\r\n"))


def squish(c: Column) -> Column:
    """Trim and reduce every inner run of white space (any Unicode space) to one space."""
    return F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def to_double(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Double, NULL for anything that is not a number; NaN counts as missing."""
    if isinstance(dtype, T.StringType):
        text = trim_ws(c)
        return F.when(text.rlike(NUMBER), text.try_cast("double"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("double"))
    return c.try_cast("double")


def to_integer(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Integer, truncated toward zero; NULL when unparsable or out of range."""
    return to_double(c, dtype).try_cast("int")


def to_boolean(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """TRUE for the affirmative words, FALSE for everything else including NULL.

    A column that is already boolean keeps its NULLs; of a numeric one only 1 is TRUE.
    """
    if isinstance(dtype, T.BooleanType):
        return c
    if isinstance(dtype, T.NumericType):
        return F.coalesce(c == 1, F.lit(False))
    return F.coalesce(F.upper(c.cast("string")).isin(*TRUE_WORDS), F.lit(False))


def to_text(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Text; whole numbers of a fractional type are written without a fraction, as codes are."""
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(2.0**53))
        return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def to_date(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Date; text must be year-month-day with '-' or '/', anything else is NULL."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(F.try_to_date(c, "yyyy-M-d"), F.try_to_date(c, "yyyy/M/d"))
    return c.try_cast("date")


def title(c: Column) -> Column:
    return F.initcap(c)
