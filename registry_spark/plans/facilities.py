"""Facility registries: one country, then all countries into the lake."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from registry_spark.countries import BOXES, ISO3, SOURCES, Box, Source, check_known
from registry_spark.operators.boundaries import filter_within, flag_within
from registry_spark.operators.columns import standardize_columns
from registry_spark.operators.coordinates import (
    clean_coordinates,
    coerce_coordinates,
    fill_from_cache,
    geocode_failures,
    geocode_pending,
    merged_answers,
)
from registry_spark.operators.identifiers import assign_uids, new_registry_rows
from registry_spark.operators.merging import stamp
from registry_spark.operators.profiles import quality_by_country, step_counters
from registry_spark.operators.partials import partial_counters
from registry_spark.operators.quality import clean_dates, flag_data_quality
from registry_spark.operators.typing import count_rejects, enforce_schema
from registry_spark.schema import FACILITY_FIELDS, GEOCODE_CACHE, UID_REGISTRY
from registry_spark.sources import lake, readers
from registry_spark.sources.runlog import RunLog
from registry_spark.sources.shared import written
from registry_spark.sources.versions import VersionedTable

# Columns whose distinct values the stored counters sketch.
COUNTED_DISTINCT = ("facility_code", "facility_name", "admin1", "facility_type")


@dataclass(frozen=True)
class LakePaths:
    """Where a run keeps its datasets."""

    root: str

    @property
    def countries(self) -> str:
        return f"{self.root}/country_standardized"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/facility_snapshots"

    @property
    def registry(self) -> str:
        return f"{self.root}/uid_registry"

    @property
    def counters(self) -> str:
        return f"{self.root}/facility_counters"

    @property
    def geocode_failures(self) -> str:
        return f"{self.root}/geocode_failures"

    @property
    def geocode_pending(self) -> str:
        return f"{self.root}/geocode_pending"

    @property
    def published(self) -> str:
        return f"{self.root}/published"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"

    @property
    def slim_services(self) -> str:
        return f"{self.root}/services_slim"

    @property
    def log(self) -> str:
        return f"{self.root}/run_log"


def standardize_country(
    raw: DataFrame,
    country: str,
    source: Source,
    *,
    boxes: dict[str, Box] = BOXES,
    edges: DataFrame | None = None,
    outside: str = "drop",
    surface: str = "sphere",
    bounded: tuple[Observation, Observation] | None = None,
    cache: DataFrame | None = None,
    on_missing: str = "drop",
    current_year: int | None = None,
) -> DataFrame:
    """Raw registry to typed, flagged facilities without identifiers; one lazy plan.

    With a geocode ``cache`` its coordinates are filled in before rows without
    coordinates are dropped. With boundary ``edges`` points outside are dropped, or
    only flagged (``outside="flag"``); edges are arcs of great circles, or straight in degrees with ``surface="plane"``.
    ``bounded`` counts the rows (``rows``) before and after that step.
    """
    if outside not in ("drop", "flag"):
        raise ValueError("outside must be 'drop' or 'flag'")
    df = standardize_columns(raw, country, source)
    if cache is not None:
        df = fill_from_cache(coerce_coordinates(df), cache)
    df = clean_coordinates(df, on_missing=on_missing, boxes=boxes)
    if bounded is not None:
        df = df.observe(bounded[0], F.count(F.lit(1)).alias("rows"))
    if edges is not None:
        df = (filter_within if outside == "drop" else flag_within)(df, edges, surface=surface)
    if bounded is not None:
        df = df.observe(bounded[1], F.count(F.lit(1)).alias("rows"))
    df = clean_dates(df, current_year=current_year)
    return flag_data_quality(enforce_schema(df, FACILITY_FIELDS).drop("data_quality_flag"))


def register_new(
    spark: SparkSession, facilities: DataFrame, path: str, created: dt.date, *, country: str = "iso", seen: dict | None = None
) -> DataFrame:
    """Add registry rows for new codes and return the registry as written.

    Identifiers are read back from the written table, never from the plan that
    minted them, so a lost task or a second run cannot give a code another one. The new rows are a version
    of the registry; if another run has added one meanwhile, they are made again on top of that.
    ``seen`` gets their number as ``minted``.
    """
    table = VersionedTable(spark, path, UID_REGISTRY)
    minted = table.update(lambda registry: new_registry_rows(facilities, registry, created, country=country))
    if seen is not None:
        seen["minted"] = minted
    return table.read()


def land_answers(spark: SparkSession, answers: DataFrame, cache_path: str, *, order: str | None = None) -> int:
    """Merge landed geocode answers into the cache; returns how many rows were written.

    One answer a query: of several in ``answers`` the one with the largest ``order``, and a landed answer stands for
    the cached one. Answers that say what the cache says write nothing, so landing a file twice changes nothing.
    """
    return VersionedTable(spark, cache_path, GEOCODE_CACHE).update(lambda cache: merged_answers(cache, answers, order=order))


def run_facilities(
    spark: SparkSession,
    raw_paths: dict[str, str],
    paths: LakePaths,
    *,
    countries: list[str] | None = None,
    sources: dict[str, Source] = SOURCES,
    codes: dict[str, str] = ISO3,
    run_date: dt.date | None = None,
    log: RunLog | None = None,
    cache_path: str | None = None,
    answers: DataFrame | None = None,
    read_options: dict | None = None,
    **options,
) -> DataFrame:
    """All requested countries: standardise, register, write; returns the merged table.

    Each country is a job of its own: one whose input is missing, damaged or does not fit its
    mapping, or that has no code in ``codes``, is logged as FAILED, and the others go on. Its prepared
    table is written once and read by the steps that follow. ``read_options`` go to the CSV reader. Geocode
    ``answers`` are merged into the cache first.
    """
    run_date = run_date or dt.date.today()
    log = log or RunLog(spark, paths.log)
    wanted = check_known(countries, sources)
    if answers is not None:
        if cache_path is None:
            raise ValueError("answers need a cache_path to go to")
        log.add("GLOBAL", "geocode_answers", "SUCCESS", {"landed": land_answers(spark, answers, cache_path)})
    if cache_path:
        options["cache"] = readers.read_geocode_cache(spark, cache_path)
    done = []
    for country in wanted:
        log.add(country, "pipeline", "START")
        try:
            iso = codes.get(country.lower())
            if iso is None:
                raise ValueError(f"no country code for '{country}'")
            raw = readers.read_registry(spark, raw_paths[country], **(read_options or {}))
            run_country(spark, raw, country, iso, sources[country], paths, run_date, log, options)
            done.append(country)
        except Exception as error:  # one country must not stop the others
            log.add(country, "pipeline", "FAILED", error)
    if not done:
        log.add("GLOBAL", "pipeline", "FAILED", "no country could be read")
        log.flush()
        raise ValueError("no country could be read")
    log.add("GLOBAL", "save", "SUCCESS", f"countries: {len(done)}")
    log.flush()
    return stamp(readers.read_standardized(spark, paths.countries), run_date)


def run_country(
    spark: SparkSession, raw: DataFrame, country: str, iso: str, source: Source, paths: LakePaths, run_date: dt.date, log: RunLog, options: dict
) -> None:
    """Prepare one country, register its new codes, write its partition and the geocode queries; log the counters."""
    bounded = Observation(f"before boundary {country}"), Observation(f"after boundary {country}")
    prepared = written(
        standardize_country(raw, country, source, current_year=run_date.year, bounded=bounded, **options).withColumn("__iso", F.lit(iso))
    )
    log.add(country, "standardize", "SUCCESS", f"columns: {len(prepared.columns) - 1}")
    minted, seen = {}, Observation(f"facilities {country}")
    registry = register_new(spark, prepared, paths.registry, run_date, country="__iso", seen=minted)
    identified = assign_uids(prepared.drop("uid"), registry, country="__iso").drop("__iso")
    counters = [c for group in step_counters().values() for c in group]
    lake.write_country_tables(identified.observe(seen, *counters), paths.countries)
    if not seen.get["rows"]:
        lake.empty_country(identified, paths.countries, title_of(country))
    table = spark.read.schema(identified.schema).parquet(paths.countries)
    write_counters(stamp(table, run_date), paths.counters, title_of(country))
    codes = prepared.filter("facility_code <> ''").agg(F.count_distinct("facility_code")).first()[0]
    log.count(country, "boundary", outside=bounded[0].get["rows"] - bounded[1].get["rows"])
    log.count(country, "facilities", **seen.get, **minted, reused=codes - minted["minted"])
    rejects = {r["column_name"]: r["rejected"] for r in raw_rejects(raw, source).collect()}
    log.add(country, "save", "SUCCESS", {**seen.get, **minted, "rejected": rejects})
    if "geocode_status" in prepared.columns:
        lake.append_rows(geocode_failures(prepared.drop("__iso")), paths.geocode_failures)
        lake.append_rows(geocode_pending(prepared), paths.geocode_pending)


def write_counters(table: DataFrame, path: str, country: str) -> None:
    """Replace the stored counters of one country from its part of the table; no other part is read."""
    part = table.filter(F.col("country") == country)
    counted = partial_counters(part, ["country", "data_quality_flag"], distinct=[c for c in COUNTED_DISTINCT if c in table.columns])
    counted.drop("country").coalesce(1).write.mode("overwrite").parquet(f"{path}/country={country}")


def title_of(country: str) -> str:
    """Country name as it stands in the tables."""
    return " ".join(word.capitalize() for word in country.split(" "))


def raw_rejects(raw: DataFrame, source: Source) -> DataFrame:
    """Per typed field of the source: non-blank raw values that do not parse."""
    mapping = source.required | source.optional
    known = {f.name: f for f in FACILITY_FIELDS}
    typed = [f for f in known if f in mapping and mapping[f] in raw.columns]
    return count_rejects(raw.select(*[F.col(f"`{mapping[f]}`").alias(f) for f in typed]), tuple(known[f] for f in typed))


def export_lake(
    spark: SparkSession,
    merged: DataFrame,
    paths: LakePaths,
    *,
    run_date: dt.date | None = None,
    table: str = "health_facilities",
    log: RunLog | None = None,
) -> DataFrame:
    """Snapshot the merged table, put the lake table over it, summarise it."""
    run_date = run_date or dt.date.today()
    log = log or RunLog(spark, paths.log)
    written = lake.write_snapshot(merged, paths.snapshots, run_date)
    lake.point_view(spark, table, written)
    log.add("GLOBAL", "data_lake", "SUCCESS", f"snapshot: {written}, table: {table}")
    log.flush()
    return quality_by_country(spark.table(table))
