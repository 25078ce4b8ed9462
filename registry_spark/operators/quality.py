"""Opening dates and the record quality flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.functions.dates import EPOCH, parse_open_date, plausible_year


def clean_dates(
    df: DataFrame,
    *,
    raw: str = "open_date_raw",
    current_year: int | None = None,
    sentinel=EPOCH,
    null_implausible: bool = False,
) -> DataFrame:
    """``open_date`` and ``open_year`` from the raw text column, which is dropped.

    An implausible year is NULL while its date is kept, unless ``null_implausible``.
    Without the raw column both are NULL.
    """
    if raw not in df.columns:
        return df.withColumns({
            "open_date": F.lit(None).cast("date"),
            "open_year": F.lit(None).cast("int"),
        })
    this_year = F.year(F.current_date()) if current_year is None else F.lit(current_year)
    dated = df.withColumn("open_date", parse_open_date(F.col(raw), sentinel))
    dated = dated.withColumn("open_year", plausible_year(F.col("open_date"), this_year))
    if null_implausible:
        dated = dated.withColumn("open_date", F.when(F.col("open_year").isNotNull(), F.col("open_date")))
    return dated.drop(raw)


def quality_flag() -> Column:
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    valid = located & F.col("coordinate_valid")
    described = F.col("facility_type").isNotNull() & F.col("ownership").isNotNull()
    return (
        F.when(~located, "low")
        .when(~F.col("coordinate_valid"), "low")
        .when(F.col("facility_name").isNull(), "low")
        .when(valid & described, "high")
        .when(valid, "medium")
        .otherwise("unknown")
    )


def flag_data_quality(df: DataFrame) -> DataFrame:
    """low: no or bad coordinates, or no name; high: also type and ownership; else medium."""
    return df.withColumn("data_quality_flag", quality_flag())
