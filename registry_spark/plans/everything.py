"""Facilities, lake export and services in one run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from registry_spark.countries import FEEDS, ISO3, SOURCES, Feed, Source, check_known
from registry_spark.operators.merging import stamp
from registry_spark.plans.facilities import LakePaths, export_lake, run_facilities
from registry_spark.plans.reports import facility_reports, service_reports, write_reports
from registry_spark.plans.services import run_services
from registry_spark.session import small_methods
from registry_spark.sources import readers
from registry_spark.sources.runlog import RunLog


def run_all(
    spark: SparkSession,
    raw_paths: dict[str, str],
    service_inputs: dict[str, tuple[str, str]],
    root: str,
    *,
    countries: list[str] | None = None,
    run_date: dt.date | None = None,
    with_facilities: bool = True,
    with_export: bool = True,
    with_services: bool = True,
    with_reports: bool = True,
    sources: dict[str, Source] = SOURCES,
    codes: dict[str, str] = ISO3,
    feeds: dict[str, Feed] = FEEDS,
    service_options: dict | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Each step can be switched off; skipped facilities are taken as last written.

    ``sources``, ``codes`` and ``feeds`` name the countries; further options go to the country step
    (boxes among them), ``service_options`` to the service step.
    """
    run_date = run_date or dt.date.today()
    paths = LakePaths(root)
    log = RunLog(spark, paths.log)
    wanted = check_known(countries, sources)
    out: dict[str, DataFrame] = {}
    with small_methods(spark):
        if with_facilities:
            merged = run_facilities(
                spark, raw_paths, paths, countries=wanted, sources=sources, codes=codes, run_date=run_date, log=log, **options
            )
        else:
            merged = stamp(readers.read_standardized(spark, paths.countries), run_date)
        out["facilities"] = merged
        if with_export:
            out["summary"] = export_lake(spark, merged, paths, run_date=run_date, log=log)
        if with_services:
            wanted_codes = [codes[c.lower()] for c in wanted if c.lower() in codes]
            out["services"] = run_services(
                spark, service_inputs, paths, countries=wanted_codes, feeds=feeds, log=log, **(service_options or {})
            )
        if with_reports:
            write_reports(facility_reports(merged), f"{paths.reports}/facilities")
            if with_services:
                write_reports(service_reports(out["services"]), f"{paths.reports}/services")
    out["log"] = log.table()
    return out
