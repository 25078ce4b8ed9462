"""Declared types and contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.functions.measures import count_true
from registry_spark.functions.text import to_boolean, to_date, to_double, to_integer, to_text
from registry_spark.schema import BOOLEAN, DATE, FLOAT, INTEGER, STRING, Field

COERCE = {FLOAT: to_double, INTEGER: to_integer, BOOLEAN: to_boolean, DATE: to_date}


def enforce_schema(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Coerce the declared columns, add absent ones as typed NULLs, keep the others."""
    present = {f.name: f.dataType for f in df.schema.fields}
    declared = {f.name for f in fields}
    columns = []
    for f in fields:
        if f.name not in present:
            column = F.lit(None).cast(f.spark_type)
        elif f.type == STRING:
            column = to_text(F.col(f.name), present[f.name])
        elif f.type in COERCE:
            column = COERCE[f.type](F.col(f.name), present[f.name])
        else:
            column = F.col(f.name)
        columns.append(column.alias(f.name))
    extras = [F.col(f"`{c}`") for c in df.columns if c not in declared]
    return df.select(*columns, *extras)


def count_rejects(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Per declared column: non-blank values the coercion turned into NULL."""
    present = {f.name: f.dataType for f in df.schema.fields}
    checked = [f for f in fields if f.name in present and f.type in (FLOAT, INTEGER, DATE)]
    counts = []
    for f in checked:
        raw = F.col(f.name)
        lost = COERCE[f.type](raw, present[f.name]).isNull() & raw.isNotNull() & (raw.cast("string") != "")
        counts.append(count_true(lost).alias(f.name))
    one = df.agg(*counts)
    return one.select(
        F.inline(F.array(*[
            F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("rejected")) for f in checked
        ]))
    )


def check_contract(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Violations per (column, rule): required, allowed, range, unique.

    Required, allowed and range are counters of one pass. Uniqueness is one
    aggregate per unique column, combined on the map side, and counts the rows
    beyond the first of each value, within the field's ``within`` column if it has
    one. Only declared columns that are present count. ``df`` is read once and
    once more per unique column: give it a written table.
    """
    fields = [f for f in fields if f.name in df.columns]
    checks = []
    for f in fields:
        c = F.col(f.name)
        if f.required:
            checks.append((f.name, "required", c.isNull()))
        if f.allowed:
            checks.append((f.name, "allowed", c.isNotNull() & ~c.isin(*f.allowed)))
        if f.low is not None:
            checks.append((f.name, "range", ~c.between(F.lit(float(f.low)), F.lit(float(f.high)))))
    parts = []
    if checks:
        one = df.agg(*[count_true(test).alias(f"c{i}") for i, (_, _, test) in enumerate(checks)])
        parts.append(one.select(F.inline(F.array(*[
            F.struct(
                F.lit(name).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"c{i}").alias("violations")
            )
            for i, (name, rule, _) in enumerate(checks)
        ]))))
    for f in fields:
        if f.unique:
            keys = [c for c in (f.within, f.name) if c in df.columns]
            copies = df.filter(F.col(f.name).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            parts.append(copies.agg(
                F.lit(f.name).alias("column_name"),
                F.lit("unique").alias("rule"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("bigint")).alias("violations"),
            ))
    return reduce(DataFrame.unionByName, parts)
