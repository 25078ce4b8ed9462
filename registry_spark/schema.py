"""Declared columns of the two published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, FLOAT, INTEGER, BOOLEAN, DATE = "string", "float", "integer", "boolean", "date"

SPARK_TYPES = {
    STRING: T.StringType(),
    FLOAT: T.DoubleType(),
    INTEGER: T.IntegerType(),
    BOOLEAN: T.BooleanType(),
    DATE: T.DateType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str = STRING
    required: bool = False
    unique: bool = False
    within: str | None = None
    allowed: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES.get(self.type, T.StringType())


# Names, types and contracts of the published tables.
COUNTRY_NAMES = (
    "Tanzania", "Uganda", "Zambia", "Nigeria", "Malawi", "Botswana", "Kenya", "Ethiopia",
)
COUNTRY_CODES = ("TZA", "MWI", "UGA", "ZMB", "NGA", "BWA", "KEN", "ETH")
OWNERSHIP_CLASSES = ("Public", "Private", "Faith-Based / NGO", "Other")
QUALITY_FLAGS = ("high", "medium", "low", "unknown")
SERVICE_DOMAINS = (
    "Clinical Services",
    "Reproductive & Maternal Health",
    "HIV/AIDS Services",
    "Malaria Services",
    "Diagnostic Services",
    "Community & Preventive Health",
    "Support Services",
)

FACILITY_FIELDS = (
    Field("uid", unique=True),
    Field("facility_code", required=True, unique=True, within="country"),
    Field("facility_name", required=True),
    Field("country", required=True, allowed=COUNTRY_NAMES),
    Field("admin1", required=True),
    Field("admin2"),
    Field("zone"),
    Field("latitude", FLOAT, required=True, low=-90, high=90),
    Field("longitude", FLOAT, required=True, low=-180, high=180),
    Field("coordinate_valid", BOOLEAN),
    Field("coordinate_source"),
    Field("facility_type", required=True),
    Field("ownership", required=True, allowed=OWNERSHIP_CLASSES),
    Field("ownership_detail"),
    Field("status"),
    Field("open_date", DATE),
    Field("open_year", INTEGER),
    Field("catchment_population", INTEGER),
    Field("urban_rural_strata"),
    Field("inpatient", BOOLEAN),
    Field("outpatient", BOOLEAN),
    Field("maternity", BOOLEAN),
    Field("emergency", BOOLEAN),
    Field("laboratory", BOOLEAN),
    Field("malaria_services", BOOLEAN),
    Field("data_source", required=True),
    Field("extraction_date", DATE),
    Field("data_quality_flag", allowed=QUALITY_FLAGS),
)

SERVICE_FIELDS = (
    Field("uid", required=True, unique=True),
    Field("facility_uid"),
    Field("country_iso", required=True, allowed=COUNTRY_CODES),
    Field("country_name", required=True, allowed=COUNTRY_NAMES),
    Field("service_domain", required=True, allowed=SERVICE_DOMAINS),
    Field("service_group", required=True),
    Field("service_name", required=True),
    Field("source_service_id"),
    Field("source_type_id"),
    Field("source_category_id"),
    Field("source_service_name", required=True),
    Field("is_clinical", BOOLEAN, required=True),
    Field("is_malaria_related", BOOLEAN, required=True),
    Field("include_in_analysis", BOOLEAN, required=True),
    Field("extracted_date", DATE),
    Field("source_url"),
    Field("pipeline_version"),
    Field("facility_code"),
    Field("needs_review", BOOLEAN),
)

SLIM_SERVICE_COLUMNS = (
    "facility_uid", "facility_code", "country_iso", "country_name",
    "service_domain", "service_group", "service_name",
    "source_category_id", "source_service_name",
    "is_clinical", "is_malaria_related", "include_in_analysis", "needs_review",
)

UID_REGISTRY = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("facility_code", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("created_date", T.DateType()),
])

GEOCODE_CACHE = T.StructType([
    T.StructField("query", T.StringType()),
    T.StructField("result_lat", T.DoubleType()),
    T.StructField("result_lon", T.DoubleType()),
    T.StructField("result_type", T.StringType()),
])

PUBLISHED = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("published_at", T.StringType()),
])

COUNTERS = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("data_quality_flag", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("non_null", T.MapType(T.StringType(), T.LongType())),
    T.StructField("sketches", T.MapType(T.StringType(), T.BinaryType())),
])

RUN_COUNTERS = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("counter", T.StringType()),
    T.StructField("n", T.LongType()),
])

RUN_LOG = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
])


def struct_type(fields) -> T.StructType:
    """The declared fields as a Spark schema, contracts kept as field metadata."""
    out = T.StructType()
    for f in fields:
        contract = {"required": f.required, "unique": f.unique, "allowed": list(f.allowed)}
        if f.low is not None:
            contract["min"], contract["max"] = f.low, f.high
        out.add(T.StructField(f.name, f.spark_type, True, contract))
    return out
