"""Service lists: one country, then all countries into the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.countries import FEEDS, Feed
from registry_spark.functions.dates import date_of_iso_datetime
from registry_spark.operators.crosswalks import translate
from registry_spark.operators.identifiers import assign_uids, service_uids
from registry_spark.operators.lookups import partitions_of
from registry_spark.operators.merging import merge_services
from registry_spark.plans.facilities import LakePaths
from registry_spark.schema import SERVICE_FIELDS
from registry_spark.session import more_partitions
from registry_spark.sources import lake, readers
from registry_spark.sources.runlog import RunLog

PIPELINE_VERSION = "2.0"
# A join of a list takes as many partitions as its files ask for, up to this.
MOST_PARTITIONS = 4_096
# Numbering of a large list takes so many for one of them: it sorts whole rows with their hash, and should not spill.
FINER = 4


def standardize_services(
    raw: DataFrame,
    iso: str,
    feed: Feed,
    crosswalk: DataFrame,
    registry: DataFrame,
    *,
    source_url: str | None = None,
    version: str = PIPELINE_VERSION,
    order_by: list[str] | None = None,
    fallback_to_source: bool = False,
    method: str = "auto",
    digits: int = 3,
    distinct: bool = False,
    finer: int = 1,
) -> DataFrame:
    """Raw service list to the 19 published columns.

    Rows are numbered and meet the registry first, with the raw columns that are used and no others, since the
    lookups keep the number of rows and the crosswalk makes them wide. ``order_by`` must tell different rows apart (default:
    all raw columns). ``distinct`` says that no row is repeated, which saves the count of copies;
    ``digits`` sets the number of numbering buckets and ``finer`` that of its partitions; they change no number.
    """

    sources = (feed.source_service_id, feed.source_type_id, feed.source_category_id, feed.source_service_name, feed.date_column)
    used = dict.fromkeys([*(raw_key for raw_key, _ in feed.join_keys), *(c for c in sources if c is not None)])
    short = {c: f"raw_{i}" for i, c in enumerate(used)}

    def text(name: str | None):
        return F.lit(None).cast("string") if name is None else F.col(short[name]).cast("string")

    named = service_uids(raw, iso, order_by, digits, collapse=not distinct, finer=finer).select(
        "uid",
        F.col("facility_code").cast("string").alias("facility_code"),
        F.lit(iso).alias("country_iso"),
        *[F.col(f"`{c}`").alias(alias) for c, alias in short.items()],
    )
    identified = assign_uids(
        named, registry.filter(F.col("country") == iso),
        country="country_iso", name="facility_uid", method=method,
    )
    prepared = identified.select(
        "uid",
        "facility_uid",
        "facility_code",
        "country_iso",
        F.lit(feed.country_name).alias("country_name"),
        *[F.col(short[raw_key]).alias(f"key_{raw_key}") for raw_key, _ in feed.join_keys],
        text(feed.source_service_id).alias("source_service_id"),
        text(feed.source_type_id).alias("source_type_id"),
        text(feed.source_category_id).alias("source_category_id"),
        text(feed.source_service_name).alias("source_service_name"),
        (
            F.lit(None).cast("date") if feed.date_column is None
            else date_of_iso_datetime(text(feed.date_column))
        ).alias("extracted_date"),
        F.lit(source_url).cast("string").alias("source_url"),
        F.lit(version).alias("pipeline_version"),
    )
    keys = tuple((f"key_{raw_key}", known) for raw_key, known in feed.join_keys)
    translated = translate(
        prepared, crosswalk, keys,
        fallback_to_source="source_service_name" if fallback_to_source else None, method=method,
    )
    return translated.select(*[f.name for f in SERVICE_FIELDS])


def run_services(
    spark: SparkSession,
    inputs: dict[str, tuple[str, str]],
    paths: LakePaths,
    *,
    countries: list[str] | None = None,
    feeds: dict[str, Feed] = FEEDS,
    table: str = "facility_services",
    log: RunLog | None = None,
    read_options: dict | None = None,
    crosswalk_options: dict | None = None,
    **options,
) -> DataFrame:
    """All service lists into one lake table; ``inputs`` maps ISO code to (list, crosswalk).

    ``countries`` are ISO codes. Each feed is a job of its own: one that cannot be read or fails while it runs is
    logged as FAILED and left out. Every feed is written once, aside, as its partition of the table, which takes the place
    of the last one only when it holds every row of the feeds. ``read_options`` and ``crosswalk_options`` go to the readers of the two.
    """
    log = log or RunLog(spark, paths.log)
    registry = readers.read_uid_registry(spark, paths.registry)
    path, counted, failed = lake.aside(table, paths.published), {}, {}
    for iso, (list_path, crosswalk_path) in inputs.items():
        if countries is not None and iso not in countries:
            continue
        done = None
        try:
            raw = readers.read_service_list(spark, list_path, **(read_options or {}))
            crosswalk = readers.read_crosswalk(spark, crosswalk_path, **(crosswalk_options or {}))
            done = merge_services([standardize_services(
                raw, iso, feeds[iso], crosswalk, registry, source_url=list_path, **{"finer": FINER, **options}
            )])
            with more_partitions(spark, partitions_of(raw, MOST_PARTITIONS)):
                done.write.mode("append").partitionBy("country_iso").parquet(path)
            files = spark.read.schema(done.schema).parquet(path).filter(F.col("country_iso") == iso)
            n, matched = files.agg(F.count(F.lit(1)), F.count("facility_uid")).first()
            counted[iso] = n
            log.count(iso, "services", rows=n, matched=matched, unmatched=n - matched)
            log.add("GLOBAL", f"services {iso}", "SUCCESS", f"rows: {n}")
        except Exception as error:  # one feed must not stop the others
            counted.pop(iso, None)
            if done is not None:
                failed[iso] = done
            log.add("GLOBAL", f"services {iso}", "FAILED", error)

    def complete(files: DataFrame) -> None:
        found, rows = files.count(), sum(counted.values())
        if found != rows:
            raise ValueError(f"{found} rows written of {rows}")

    try:
        if not counted:
            raise ValueError("no service list could be read")
        for iso, done in failed.items():  # what a feed may have written before it failed
            lake.empty_country(done, path, iso, column="country_iso")
        lake.publish_files(spark, table, paths.published, path, check=complete)
        lake.write_slim_services(spark.table(table), paths.slim_services, list(counted))
        log.add("GLOBAL", "services", "SUCCESS", f"table: {table}")
    except Exception as error:
        log.add("GLOBAL", "services", "FAILED", error)
        raise
    finally:
        log.flush()
    return spark.table(table)
