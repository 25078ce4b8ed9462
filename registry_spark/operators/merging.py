"""Country tables into one."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.functions.text import title
from registry_spark.operators.typing import enforce_schema
from registry_spark.schema import FACILITY_FIELDS, SERVICE_FIELDS


def union_all(frames: list[DataFrame]) -> DataFrame:
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_countries(frames: dict[str, DataFrame], run_date: dt.date | Column | None = None) -> DataFrame:
    """Typed union of country tables; a NULL country is filled from the table's label."""
    typed = [
        enforce_schema(df, FACILITY_FIELDS).withColumn(
            "country", F.coalesce(F.col("country"), title(F.lit(label)))
        )
        for label, df in frames.items()
    ]
    return stamp(union_all(typed), run_date)


def stamp(df: DataFrame, run_date: dt.date | Column | None = None) -> DataFrame:
    """Extraction date on every row; today unless given."""
    if run_date is None:
        run_date = F.current_date()
    date = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return df.withColumn("extraction_date", date.cast("date"))


def merge_services(frames: list[DataFrame]) -> DataFrame:
    """Union of service tables on the published columns, source ids as text."""
    names = [f.name for f in SERVICE_FIELDS]
    aligned = []
    for df in frames:
        columns = [c for c in names if c in df.columns]
        ids = ("source_service_id", "source_type_id", "source_category_id")
        aligned.append(df.select(*[F.col(c).cast("string") if c in ids else F.col(c) for c in columns]))
    return union_all(aligned)
