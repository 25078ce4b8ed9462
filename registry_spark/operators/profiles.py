"""Counts, completeness and distributions, each one aggregate over its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_spark.functions.measures import count_true, percent_half_even, percent_half_up
from registry_spark.operators.hot_keys import join_heavy


def completeness(df: DataFrame, by: str | None = None) -> DataFrame:
    """Share of non-NULL values per column, all counters in one pass, optionally per ``by`` value."""
    columns = [c for c in df.columns if c != by]
    groups = [] if by is None else [F.col(f"`{by}`")]
    counted = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(F.col(f"`{c}`")).alias(f"__c{i}") for i, c in enumerate(columns)],
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__c{i}").alias("non_null")) for i, c in enumerate(columns)
    ])
    missing = percent_half_even(F.col("n_rows") - F.col("non_null"), F.col("n_rows"))
    return counted.select(*groups, F.col("__n").alias("n_rows"), F.inline(rows)).select(
        *groups, "column_name", "non_null", "n_rows", F.bround(F.lit(100.0) - missing, 1).alias("pct_non_null")
    )


def distribution(df: DataFrame, column: str, *, digits: int = 1) -> DataFrame:
    """Count and share of all rows per value; NULL is in the total but not listed.

    The total is a scalar over the counts, which are computed once.
    """
    counts = df.groupBy(F.col(f"`{column}`")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.filter(F.col(f"`{column}`").isNotNull()).withColumn("pct", percent_half_even(F.col("n"), total, digits))


def quality_by_country(df: DataFrame) -> DataFrame:
    """Facilities per country and quality flag with the share of the country."""
    per_country = F.sum("n_facilities").over(Window.partitionBy("country"))
    return (
        df.groupBy("country", F.coalesce("data_quality_flag", F.lit("(null)")).alias("data_quality_flag"))
        .agg(F.count(F.lit(1)).alias("n_facilities"))
        .withColumn("pct_of_country", percent_half_up(F.col("n_facilities"), per_country))
    )


def service_report(df: DataFrame) -> DataFrame:
    """Totals of a service table in one row; shares are NULL on an empty table.

    A missing facility code counts as one facility value.
    """
    code_missing = F.max(F.when(F.col("facility_code").isNull(), F.lit(1)).otherwise(F.lit(0)))
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        (F.count_distinct("facility_code") + F.coalesce(code_missing, F.lit(0))).alias("unique_facilities"),
        F.count("facility_uid").alias("matched_uid"),
        (F.count(F.lit(1)) - F.count("facility_uid")).alias("unmatched_uid"),
        count_true(F.col("include_in_analysis")).alias("included"),
        count_true(F.col("needs_review")).alias("to_review"),
    ).withColumn("pct_matched", percent_half_even(F.col("matched_uid"), F.col("total_records")))


def unmatched_pairs(df: DataFrame) -> DataFrame:
    """Distinct (facility, source name) of rows without a standard domain."""
    return df.filter(F.col("service_domain").isNull()).select("facility_code", "source_service_name").distinct()


def unmatched_report(df: DataFrame, top: int = 50) -> DataFrame:
    """The first ``top`` unmatched pairs and how many more there are."""
    pairs = unmatched_pairs(df)
    total = pairs.agg(F.count(F.lit(1)).alias("n")).scalar()
    first = pairs.orderBy("facility_code", "source_service_name").limit(top)
    return first.withColumn("n_more", F.greatest(total - F.lit(top), F.lit(0)))


def source_profile(df: DataFrame, id_column: str, distinct: dict[str, str], located: str | None = None) -> DataFrame:
    """Rows, distinct values per named column, and the share with a location.

    One narrow aggregate per distinct count, so that no row is multiplied by their number.
    """

    def values(column: str) -> Column:
        return df.agg(F.count_distinct(F.col(f"`{column}`")).alias("n")).scalar()

    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    if located:
        aggregates.append(percent_half_even(F.count(F.col(f"`{located}`")), F.count(F.lit(1))).alias("pct_located"))
    counted = df.agg(*aggregates).withColumns({"n_ids": values(id_column)} | {name: values(c) for name, c in distinct.items()})
    return counted.select("n_ids", "n_rows", *distinct, *["pct_located"] * bool(located))


def counts_by(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def included(df: DataFrame) -> DataFrame:
    return df.filter(F.col("include_in_analysis"))


def malaria_services(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_malaria_related") & F.col("include_in_analysis"))


def malaria_counts(df: DataFrame) -> DataFrame:
    """Rows per country, group and name among included malaria services."""
    return counts_by(malaria_services(df), "country_name", "service_group", "service_name", name="facilities")


def facilities_with_services(facilities: DataFrame, services: DataFrame, *, share: float | None = None) -> DataFrame:
    """Service rows joined to their facility by identifier, inner.

    Rows without an identifier go before the shuffle, and only the columns asked
    for travel. A facility may have several rows, so nothing bounds a broadcast
    here. Facilities that hold many of the services (``share`` of them, by default a shuffle partition's) are shared
    by several tasks; only their rows are copied.
    """
    f = facilities.filter(F.col("uid").isNotNull()).select(
        F.col("uid").alias("facility_uid"), "facility_name", "latitude", "longitude", "country"
    )
    s = services.select("facility_uid", "service_name", "service_domain")
    return join_heavy(s, f, "facility_uid", share=share).select(
        "facility_name", "latitude", "longitude", "country", "service_name", "service_domain"
    )


def orphan_codes(services: DataFrame, registry: DataFrame, *, country: str = "country_iso") -> DataFrame:
    """Service rows per (country, code) that no registry row knows."""
    used = counts_by(services.filter(F.col("facility_code").isNotNull()), country, "facility_code")
    known = registry.select(F.col("country").alias(country), "facility_code").distinct()
    return used.join(known, [country, "facility_code"], "left_anti")


def conflicting_keys(crosswalk: DataFrame, keys: list[str]) -> DataFrame:
    """Keys listed with different translations, of which ``translate`` uses the smallest: the keys and how many rows."""
    return crosswalk.distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def crosswalk_quality(crosswalk: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Rows per domain and per include flag, rows to review, rows without a domain; with ``keys`` also keys in conflict."""
    flag = F.coalesce(F.col("include_in_analysis").cast("string"), F.lit("(null)"))
    facts = F.array(
        F.struct(F.lit("domain").alias("measure"), F.coalesce("service_domain", F.lit("(null)")).alias("value")),
        F.struct(F.lit("include_in_analysis").alias("measure"), flag.alias("value")),
        F.when(F.col("needs_review"), F.struct(F.lit("needs_review").alias("measure"), F.lit("true").alias("value"))),
        F.when(F.col("service_domain").isNull(), F.struct(
            F.lit("without_rule").alias("measure"), F.coalesce("source_category", F.lit("(null)")).alias("value"))),
    )
    counted = (
        crosswalk.select(F.explode(facts).alias("fact"))
        .filter(F.col("fact").isNotNull())
        .groupBy(F.col("fact.measure"), F.col("fact.value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if not keys:
        return counted
    conflicts = conflicting_keys(crosswalk, [*keys]).agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(conflicts.select(F.lit("conflicting_keys").alias("measure"), F.lit("all").alias("value"), "n"))


def step_counters() -> dict[str, list]:
    """Counters of the facility steps, for ``df.observe`` (no pass of their own)."""
    return {
        "coordinates": [
            F.count(F.lit(1)).alias("rows"),
            count_true(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("missing"),
            count_true(F.col("coordinate_valid")).alias("valid"),
            count_true(~F.col("coordinate_valid")).alias("invalid"),
        ],
        "dates": [
            F.count("open_date").alias("dated"),
            count_true(F.col("open_date").isNull()).alias("undated"),
        ],
        "uids": [
            F.count("uid").alias("assigned"),
            count_true(F.col("uid").isNull()).alias("skipped"),
        ],
    }
