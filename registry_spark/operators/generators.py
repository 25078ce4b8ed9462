"""Delimited and nested service lists to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry_spark.functions.text import blank_to_null, squish, to_double, to_integer

# Delimited source columns and the category each one stands for.
LIST_COLUMNS = {
    "Clinical Services": "clinical_services",
    "Support Services": "support_services",
    "Diagnostic Services": "diagnostic_services",
    "24Hr Services": "twenty_four_hour",
}

_NAMED = T.StructType([T.StructField("name", T.StringType())])
_INFRA_TYPE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("isStaff", T.BooleanType()),
    T.StructField("staff", T.BooleanType()),
    T.StructField("isAvailable", T.BooleanType()),
    T.StructField("available", T.BooleanType()),
])

# Numbers are read as text and coerced later, since the source writes both.
PAYLOAD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("newFacilityCode", T.StringType()),
    T.StructField("oldFacilityCode", T.StringType()),
    T.StructField("facilityName", T.StringType()),
    T.StructField("district", _NAMED),
    T.StructField("physicalAddress", T.StructType([T.StructField("district", _NAMED)])),
    T.StructField("constituency", _NAMED),
    T.StructField("facilityType", _NAMED),
    T.StructField("facilityOwner", T.StringType()),
    T.StructField("lat", T.StringType()),
    T.StructField("lng", T.StringType()),
    T.StructField("telephone", T.StringType()),
    T.StructField("isUrbanOrRural", T.StringType()),
    T.StructField("isAlwaysOpen", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("facilityStatus", T.StringType()),
    T.StructField("catchmentArea", T.StringType()),
    T.StructField("updated", T.StringType()),
    T.StructField("facilityServices", T.ArrayType(_NAMED)),
    T.StructField("knownYesNoInfrastructures", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("isAvailable", T.BooleanType()),
        T.StructField("available", T.BooleanType()),
    ]))),
    T.StructField("facilityInfrastructures", T.ArrayType(T.StructType([
        T.StructField("quantity", T.StringType()),
        T.StructField("facilityInfrastructureType", _INFRA_TYPE),
    ]))),
])


def split_lists(
    df: DataFrame,
    code: str,
    columns: dict[str, str] = LIST_COLUMNS,
    *,
    separator: str = ";",
) -> DataFrame:
    """One row per non-blank item of the delimited columns, tagged with its category.

    All columns are unpivoted in one scan. ``separator`` is a regular expression.
    """
    lists = F.array(*[
        F.struct(F.lit(category).alias("service_category"), F.col(f"`{raw}`").alias("items"))
        for raw, category in columns.items()
    ])
    return (
        df.select(F.col(f"`{code}`").alias("facility_code"), F.inline(lists))
        .select("facility_code", "service_category", F.explode(F.split("items", separator)).alias("service_name"))
        .withColumn("service_name", squish(F.col("service_name")))
        .filter(F.col("service_name") != "")
    )


def _either(entry: Column, *flags: str) -> Column:
    test = F.lit(False)
    for flag in flags:
        test = test | F.coalesce(entry[flag], F.lit(False))
    return test


def preferred_code() -> Column:
    return F.coalesce(blank_to_null(F.col("newFacilityCode")), F.col("id"))


def payload_facilities(payload: DataFrame) -> DataFrame:
    """Flat facility table of the nested payload, under the export's column names."""
    return payload.select(
        F.col("facilityName").alias("Facility Name"),
        preferred_code().alias("New Facility Code"),
        F.col("oldFacilityCode").alias("Old Facility Code"),
        F.col("district.name").alias("District"),
        F.col("physicalAddress.district.name").alias("Sub-District"),
        F.col("constituency.name").alias("Constituency"),
        F.col("facilityType.name").alias("Service Delivery Type"),
        F.col("facilityOwner").alias("Facility Owner"),
        to_double(F.col("lat")).alias("Latitude"),
        to_double(F.col("lng")).alias("Longitude"),
        F.col("telephone").alias("Telephone"),
        F.col("isUrbanOrRural").alias("Urban or Rural"),
        F.coalesce(F.col("isAlwaysOpen"), F.lit(False)).alias("Always Open"),
        F.col("status").alias("Facility Status"),
        F.col("facilityStatus").alias("Publication Status"),
        F.col("catchmentArea").alias("Catchment Area"),
        F.col("updated").alias("Updated"),
    )


def payload_services(payload: DataFrame) -> DataFrame:
    """One row per service item of the nested payload.

    Clinical services, yes/no infrastructure and counted infrastructure (staff or
    equipment) of a facility are put into one array and exploded once. Items
    without a name and items reported absent are left out.
    """

    def item(category: Column, name: Column, quantity: Column, available: Column) -> Column:
        return F.struct(
            category.alias("service_category"),
            name.alias("service_name"),
            quantity.alias("quantity"),
            available.alias("is_available"),
        )

    no_quantity = F.lit(None).cast("int")
    clinical = F.transform("facilityServices", lambda s: item(
        F.lit("clinical_services"), s["name"], no_quantity, F.lit(True)))
    yes_no = F.transform("knownYesNoInfrastructures", lambda y: item(
        F.lit("infrastructure"), y["type"], no_quantity, _either(y, "isAvailable", "available")))
    counted = F.transform("facilityInfrastructures", lambda i: item(
        F.when(_either(i["facilityInfrastructureType"], "isStaff", "staff"), "staff").otherwise("infrastructure"),
        i["facilityInfrastructureType"]["type"],
        to_integer(F.coalesce(i["quantity"], F.lit("0"))),
        _either(i["facilityInfrastructureType"], "isAvailable", "available")))
    empty = F.array().cast(
        "array<struct<service_category:string,service_name:string,quantity:int,is_available:boolean>>"
    )
    items = F.concat(*[F.coalesce(part, empty) for part in (clinical, yes_no, counted)])
    return (
        payload.select(preferred_code().alias("facility_code"), F.inline(items))
        .filter((F.col("service_name") != "") & (F.col("is_available").isNull() | F.col("is_available")))
    )
