"""Report tables of a finished run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.operators import partials, profiles
from registry_spark.operators.typing import check_contract
from registry_spark.schema import COUNTERS, FACILITY_FIELDS, SERVICE_FIELDS


def write_reports(reports: dict[str, DataFrame], path: str) -> None:
    """One small table per report, replaced by every run."""
    for name, table in reports.items():
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def facility_reports(facilities: DataFrame) -> dict[str, DataFrame]:
    """Rows, completeness and quality per country, and broken contracts."""
    return {
        "countries": profiles.counts_by(facilities, "country", name="facilities").orderBy("country"),
        "completeness": profiles.completeness(facilities, by="country"),
        "quality": profiles.quality_by_country(facilities).orderBy("country", "data_quality_flag"),
        "quality_overall": profiles.distribution(facilities, "data_quality_flag"),
        "contract": check_contract(facilities, FACILITY_FIELDS),
    }


def stored_reports(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Reports from the counters that runs keep by country: no facility is read, whatever the size of the lake."""
    counters = spark.read.schema(COUNTERS).parquet(path)
    return {
        "countries": partials.rows_by(counters, "country", name="facilities").orderBy("country"),
        "completeness": partials.completeness_from(counters, by="country"),
        "quality": partials.quality_from(counters).orderBy("country", "data_quality_flag"),
        "distinct": partials.distinct_from(counters, "country"),
        "distinct_overall": partials.distinct_from(counters),
    }


def service_reports(services: DataFrame) -> dict[str, DataFrame]:
    """Totals, domains, unmatched names, malaria services and broken contracts."""
    return {
        "totals": profiles.service_report(services),
        "countries": profiles.counts_by(services, "country_name", name="records"),
        "domains": profiles.distribution(services, "service_domain").orderBy(F.desc("n"), "service_domain"),
        "included_domains": profiles.counts_by(profiles.included(services), "service_domain").orderBy(
            F.desc("n"), "service_domain"),
        "unmatched": profiles.unmatched_report(services),
        "malaria": profiles.malaria_counts(services).orderBy(
            "country_name", F.desc("facilities"), "service_group", "service_name"),
        "contract": check_contract(services, SERVICE_FIELDS),
    }
