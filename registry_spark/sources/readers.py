"""Registries, service lists, crosswalks, payloads and state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry_spark.functions.text import blank_to_null
from registry_spark.operators.columns import trim_column_names
from registry_spark.operators.crosswalks import trim_text
from registry_spark.operators.generators import PAYLOAD
from registry_spark.schema import GEOCODE_CACHE, UID_REGISTRY
from registry_spark.sources.records import read_records
from registry_spark.sources.versions import VersionedTable

FLAG_COLUMNS = ("is_clinical", "is_malaria_related", "include_in_analysis", "needs_review")


def read_text_csv(
    spark: SparkSession, path: str, *, encoding: str = "UTF-8", multi_line: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """CSV with a header, every column text, ``NA`` and empty fields NULL.

    Types come later from the declared schema, so codes such as ``000123`` or
    ``100000`` stay as written. ``multi_line`` allows line breaks inside quoted
    fields; files are read in blocks all the same. A record
    with too few or too many fields, as a line break in a quoted field makes without it, stops
    the read; ``mode="PERMISSIVE"`` fills or cuts such records instead.
    """
    if multi_line:
        df = read_records(spark, path, encoding=encoding, mode=mode)
        return df.select(*[blank_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])
    df = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("nullValue", "NA")
        .option("escape", '"')
        .option("mode", mode)
        .option("columnPruning", False)
        .csv(path)
    )
    return df.select(*[blank_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_registry(spark: SparkSession, path: str, **options) -> DataFrame:
    """A country's facility registry: Latin-1 CSV, or Parquet, column names trimmed."""
    name = path.lower().rstrip("/")
    if name.endswith(".csv"):
        df = read_text_csv(spark, path, encoding="ISO-8859-1", **options)
    elif name.endswith(".parquet"):
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported file type: {path} (convert spreadsheets to CSV or Parquet first)")
    return trim_column_names(df)


def read_service_list(spark: SparkSession, path: str, **options) -> DataFrame:
    if path.lower().rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return read_text_csv(spark, path, **options)


def read_crosswalk(spark: SparkSession, path: str, **options) -> DataFrame:
    """Crosswalk CSV with trimmed text and boolean flags."""
    df = trim_text(read_text_csv(spark, path, **options))
    flags = [c for c in FLAG_COLUMNS if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("boolean") for c in flags})


def read_payload(spark: SparkSession, path: str, *, multi_line: bool = True, schema: T.StructType = PAYLOAD):
    """Nested facility objects: one JSON array per file, or one object per line.

    A file with an array is read by one task; land large dumps as lines
    (``multi_line=False``), which split.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_uid_registry(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Identifiers given out, as of a version (default: the last)."""
    return VersionedTable(spark, path, UID_REGISTRY).read(version)


def read_geocode_cache(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    return VersionedTable(spark, path, GEOCODE_CACHE).read(version)


def read_standardized(spark: SparkSession, path: str) -> DataFrame:
    """All standardised country tables (one dataset partitioned by country)."""
    return spark.read.option("mergeSchema", True).parquet(path)
