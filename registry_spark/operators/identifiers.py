"""Stable identifiers for facilities and service rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.operators.lookups import first_per_key, lookup_join
from registry_spark.operators.numbering import number_rows


def uid_text(prefix: Column, number: Column) -> Column:
    """``TZA-000142``; longer numbers are not cut; NULL when a part is NULL."""
    digits = number.cast("string")
    padded = F.when(number < 0, F.format_string("%06d", number)).when(F.length(digits) < 6, F.lpad(digits, 6, "0")).otherwise(digits)
    return F.concat(prefix, F.lit("-"), padded)


def highest_numbers(registry: DataFrame) -> DataFrame:
    """Largest number already given out, per country code."""
    number = F.regexp_extract("uid", r"(\d+)$", 1).try_cast("bigint")
    return registry.groupBy("country").agg(F.max(number).alias("highest"))


def new_registry_rows(
    facilities: DataFrame,
    registry: DataFrame,
    created: dt.date | Column,
    *,
    country: str = "iso",
    code: str = "facility_code",
    digits: int = 3,
) -> DataFrame:
    """Registry rows for the (country, code) pairs that have none yet.

    One identifier per distinct pair, numbered on from the country's highest. Rows
    without a country or a code get no identifier.
    """
    wanted = (
        facilities.select(F.col(country).alias("country"), F.col(code).cast("string").alias("facility_code"))
        .filter(F.col("country").isNotNull() & F.col("facility_code").isNotNull() & (F.col("facility_code") != ""))
        .distinct()
    )
    unseen = wanted.join(registry.select("country", "facility_code"), ["country", "facility_code"], "left_anti")
    numbered = number_rows(
        unseen, ["facility_code"], within=["country"], name="n", digits=digits, collapse=False
    )
    highest = highest_numbers(registry)
    created = created if isinstance(created, Column) else F.lit(created)
    return numbered.join(highest, "country", "left").select(
        "country",
        "facility_code",
        uid_text(F.col("country"), F.coalesce(F.col("highest"), F.lit(0)) + F.col("n")).alias("uid"),
        created.cast("date").alias("created_date"),
    )


def one_uid_per_code(registry: DataFrame) -> DataFrame:
    """Registry with one row per (country, code): the identifier given out first."""
    numbered = registry.select(
        "country", "facility_code", F.length("uid").alias("uid_length"), "uid"
    )
    return first_per_key(numbered, ["country", "facility_code"], ["uid_length", "uid"]).drop("uid_length")


def assign_uids(
    facilities: DataFrame,
    registry: DataFrame,
    *,
    country: str = "iso",
    code: str = "facility_code",
    name: str = "uid",
    method: str = "auto",
) -> DataFrame:
    """Add each row's registered identifier; NULL without a code or a registry row."""
    coded = registry.filter(F.col("facility_code") != "").select("country", "facility_code", "uid")
    lookup = one_uid_per_code(coded).withColumnRenamed("uid", name)
    return lookup_join(
        facilities, lookup, [(country, "country"), (code, "facility_code")], method=method
    )


def assign_uids_layered(
    facilities: DataFrame,
    base: DataFrame,
    recent: DataFrame,
    *,
    country: str = "iso",
    code: str = "facility_code",
    name: str = "uid",
) -> DataFrame:
    """As ``assign_uids`` with the union of both: ``base`` as a table bucketed by (country, facility_code), of which
    nothing is shuffled, and ``recent``, the rows given out since. A code's identifier in ``base`` came first.
    """
    known = assign_uids(facilities, base, country=country, code=code, name=name, method="shuffle")
    both = assign_uids(known, recent, country=country, code=code, name="__recent")
    return both.withColumn(name, F.coalesce(name, "__recent")).drop("__recent")


def service_uids(
    df: DataFrame, iso: str, order_by: list[str] | None = None, digits: int = 3, *, collapse: bool = True, finer: int = 1
) -> DataFrame:
    """Add ``uid`` = ``{iso}-SVC-{number}`` to every row of one service list."""
    numbered = number_rows(df, order_by or df.columns, name="__number", digits=digits, collapse=collapse, finer=finer)
    return numbered.withColumn("uid", uid_text(F.lit(f"{iso}-SVC"), F.col("__number"))).drop("__number")
