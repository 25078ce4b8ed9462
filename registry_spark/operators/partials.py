"""Counters that are kept with each part of a table and merged for any report, so that reports read no facilities.

A partial row holds, for one combination of the ``by`` columns: n_rows, non_null (column to count) and sketches
(column to a mergeable distinct-count sketch). Sums and unions of such rows are those of the rows behind them; a
changed part replaces only its own partial rows.

Distinct counts are estimates: with the default 2^14 registers the standard error is 0.8 %. ``count_distinct`` over the
rows stays the exact way (``profiles.source_profile``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registry_spark.functions.measures import percent_half_even, percent_half_up

REGISTERS = 14  # binary logarithm


def partial_counters(df: DataFrame, by: list[str], *, distinct: list[str] = (), registers: int = REGISTERS) -> DataFrame:
    """Partial rows of a table, one aggregate with a map-side combine. NULL is a value of a ``by`` column of its own.

    Every column not in ``by`` is counted; ``distinct`` names those that get a sketch (of their text; NULL is no value).
    """
    counted = [c for c in df.columns if c not in by]
    out = df.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"__n{i}") for i, c in enumerate(counted)],
        *[F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), registers).alias(f"__d{i}") for i, c in enumerate(distinct)],
    )

    def entries(names: list[str], prefix: str, kind: str):
        pairs = [part for i, c in enumerate(names) for part in (F.lit(c), F.col(f"{prefix}{i}"))]
        return (F.create_map(*pairs) if pairs else F.create_map()).cast(f"map<string,{kind}>")

    return out.select(
        *[F.col(f"`{c}`") for c in by], "n_rows",
        entries(counted, "__n", "bigint").alias("non_null"), entries([*distinct], "__d", "binary").alias("sketches"),
    )


def rows_by(partials: DataFrame, *by: str, name: str = "n") -> DataFrame:
    return partials.groupBy(*by).agg(F.sum("n_rows").alias(name))


def completeness_from(partials: DataFrame, by: str | None = None) -> DataFrame:
    """As ``profiles.completeness`` of the rows behind the partials, for the columns that these count."""
    groups = [] if by is None else [F.col(f"`{by}`")]
    merged = partials.select(*groups, "n_rows", F.explode("non_null").alias("column_name", "k")).groupBy(*groups, "column_name").agg(
        F.sum("k").alias("non_null"), F.sum("n_rows").alias("n_rows"))
    missing = percent_half_even(F.col("n_rows") - F.col("non_null"), F.col("n_rows"))
    return merged.withColumn("pct_non_null", F.bround(F.lit(100.0) - missing, 1))


def quality_from(partials: DataFrame) -> DataFrame:
    """As ``profiles.quality_by_country``; the partials are kept by country and data_quality_flag."""
    flag = F.coalesce("data_quality_flag", F.lit("(null)")).alias("data_quality_flag")
    per_country = F.sum("n_facilities").over(Window.partitionBy("country"))
    return partials.groupBy("country", flag).agg(F.sum("n_rows").alias("n_facilities")).withColumn(
        "pct_of_country", percent_half_up(F.col("n_facilities"), per_country))


def distinct_from(partials: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct values of every sketched column: ``by``, column_name, n_distinct."""
    opened = partials.select(*[F.col(f"`{c}`") for c in by], F.explode("sketches").alias("column_name", "sketch"))
    return opened.groupBy(*by, "column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
