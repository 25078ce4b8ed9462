"""Source exports turned into the registry files the country step reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.operators.crosswalks import crosswalk_from_categories, crosswalk_from_names, vocabulary
from registry_spark.operators.generators import LIST_COLUMNS, payload_facilities, payload_services, split_lists
from registry_spark.operators.lookups import first_per_key, lookup_join

# Export column -> registry column.
LOCATED_COLUMNS = {
    "Facility ID": "facility_code",
    "Facility Name": "facility_name",
    "Facility Type": "facility_type",
    "Ownership": "facility_ownership",
    "Region": "admin1",
    "Zone": "admin2",
    "Woreda": "admin3",
    "Latitude": "latitude",
    "Longitude": "longitude",
    "Operational Status": "status",
}


def located_list(
    source: DataFrame,
    points: DataFrame,
    *,
    columns: dict[str, str] = LOCATED_COLUMNS,
    code: str = "Facility ID",
    order_by: list[str] | None = None,
    method: str = "auto",
) -> DataFrame:
    """Facility list with coordinates from a second list, one row per code.

    ``points`` has ``Id``, ``Latitude``, ``Longitude``. Both codes are compared as
    text. Of several rows with one code the first by ``order_by`` (names of the
    result, default all) is kept; codes are reduced before the lookup.
    """
    known = points.select(F.col("Id").cast("string").alias("Id"), "Latitude", "Longitude")
    known = first_per_key(known, ["Id"], ["Latitude", "Longitude"])
    plain = source.withColumn(code, F.col(f"`{code}`").cast("string")).select(
        *[F.col(f"`{raw}`").alias(name) for raw, name in columns.items() if raw not in ("Latitude", "Longitude")]
    )
    one = first_per_key(plain, [columns[code]], order_by or [])
    located = lookup_join(one, known, [(columns[code], "Id")], method=method)
    return located.select(*[F.col(raw if raw in ("Latitude", "Longitude") else name).alias(name)
                            for raw, name in columns.items()])


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def prepare_payload(payload: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Nested payload to a flat registry and its service list, both written and read back."""
    return _written(payload_facilities(payload), f"{root}/registry"), _written(payload_services(payload), f"{root}/services")


def prepare_wide_list(
    source: DataFrame, points: DataFrame, root: str, *, code: str = "Facility ID", lists: dict[str, str] = LIST_COLUMNS, **options
) -> tuple[DataFrame, DataFrame]:
    """Wide list to a located registry and one row per listed item, both written and read back."""
    located = located_list(source, points, code=code, **options)
    return _written(located, f"{root}/registry"), _written(split_lists(source, code, lists), f"{root}/services")


def build_crosswalk(services: DataFrame, path: str, *, category: str, name: str, by: str = "names") -> DataFrame:
    """Crosswalk of a service list's own vocabulary, by name rules or by categories, written and read back."""
    pairs = vocabulary(services, [category, name], drop_nulls=True)
    if by not in ("names", "categories"):
        raise ValueError("by must be 'names' or 'categories'")
    made = crosswalk_from_names(pairs, category, name) if by == "names" else crosswalk_from_categories(pairs, category, name)
    return _written(made, path)
