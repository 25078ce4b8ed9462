"""Raw source columns onto the standard names."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.countries import Source
from registry_spark.functions.rules import first_match
from registry_spark.functions.text import title
from registry_spark.vocabularies import OWNERSHIP_DEFAULT, OWNERSHIP_RULES

# Computed here for every source, so a raw column of the same name is replaced.
COMPUTED = ("ownership", "country", "data_source")


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def classify_ownership(text):
    """Broad ownership class of a free-text owner; NULL text is "Other"."""
    return first_match(F.lower(text), OWNERSHIP_RULES, OWNERSHIP_DEFAULT)


def standardize_columns(df: DataFrame, country: str, source: Source) -> DataFrame:
    """Rename mapped columns, classify ownership, add country and source label.

    A missing required column is an error, a missing optional one a warning. All
    columns are taken from the raw table in one projection, so a raw column may be
    called like a standard one. Unmapped columns are kept; where such a name is
    taken by a standard column it gets the suffix ``_source``.
    """
    present = set(df.columns)
    mapping: dict[str, str] = {}
    for standard, raw in source.required.items():
        if raw not in present:
            raise ValueError(f"[{country}] required raw column '{raw}' missing: cannot produce '{standard}'")
        mapping[standard] = raw
    for standard, raw in source.optional.items():
        if raw in present:
            mapping[standard] = raw
        else:
            warnings.warn(f"[{country}] column '{raw}' not found in raw data for field '{standard}'", stacklevel=2)

    owner = mapping.pop("ownership_raw", None)
    computed = {
        "ownership": classify_ownership(F.col(f"`{owner}`")) if owner else F.lit(None).cast("string"),
        "country": title(F.lit(country)),
        "data_source": F.lit(source.data_source),
    }
    taken = {name.lower() for name in (*mapping, *computed)}
    used = {*mapping.values(), owner}
    extras = []
    for raw in df.columns:
        if raw in used or raw in COMPUTED:
            continue
        name = f"{raw}_source" if raw.lower() in taken else raw
        extras.append(F.col(f"`{raw}`").alias(name))
    return df.select(
        *[F.col(f"`{raw}`").alias(standard) for standard, raw in mapping.items()],
        *[column.alias(standard) for standard, column in computed.items()],
        *extras,
    )
