"""The countries the registries cover, and how each source names its columns.

Everything here is a default: every operator takes its own mapping, box or feed.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Box:
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


@dataclass(frozen=True)
class Source:
    """One facility registry: its label and raw column per standard field."""

    data_source: str
    required: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Feed:
    """One service list: crosswalk keys and where its source columns are."""

    country_name: str
    join_keys: tuple[tuple[str, str], ...]
    source_service_name: str
    source_service_id: str | None = None
    source_type_id: str | None = None
    source_category_id: str | None = None
    date_column: str | None = None


# ISO 3166-1 alpha-3 code of each covered country.
ISO3 = {
    "tanzania": "TZA",
    "uganda": "UGA",
    "zambia": "ZMB",
    "malawi": "MWI",
    "nigeria": "NGA",
    "botswana": "BWA",
    "kenya": "KEN",
    "ethiopia": "ETH",
}

# Generous extent of each country; edges are inside.
BOXES = {
    "tanzania": Box(lat_min=-12, lat_max=0, lon_min=28, lon_max=41),
    "uganda": Box(lat_min=-2, lat_max=5, lon_min=29, lon_max=36),
    "zambia": Box(lat_min=-19, lat_max=-7, lon_min=21, lon_max=35),
    "malawi": Box(lat_min=-18, lat_max=-8, lon_min=32, lon_max=37),
    "nigeria": Box(lat_min=3, lat_max=15, lon_min=2, lon_max=16),
    "botswana": Box(lat_min=-28, lat_max=-17, lon_min=19, lon_max=30),
    "kenya": Box(lat_min=-5, lat_max=6, lon_min=33, lon_max=42),
    "ethiopia": Box(lat_min=3, lat_max=15, lon_min=33, lon_max=48),
}

# Label and raw column names of each registry export.
SOURCES = {
    "tanzania": Source(
        data_source="MoH Tanzania Health Facility Registry (HFR) 2026",
        required={
            "facility_name": "name",
            "facility_code": "facility_code",
            "admin1": "region",
            "facility_type": "facilitytypegroup",
            "latitude": "latitude",
            "longitude": "longitude",
        },
        optional={
            "ownership_raw": "ownershipgroup",
            "ownership_detail": "ownership",
            "admin2": "district",
            "zone": "zone",
            "status": "operatingstatus",
            "open_date_raw": "date",
            "catchment_population": "population",
        },
    ),
    "malawi": Source(
        data_source="Malawi Health Facility Registry (MHFR)",
        required={
            "facility_name": "facility_name",
            "facility_code": "facility_code",
            "admin1": "admin1",
            "facility_type": "facility_type",
            "latitude": "latitude",
            "longitude": "longitude",
        },
        optional={"ownership_raw": "facility_ownership", "status": "status"},
    ),
    "uganda": Source(
        data_source="Uganda Ministry of Health Master Facility List (MFL)",
        required={
            "facility_name": "short_name",
            "facility_code": "mfl_uid",
            "admin1": "region",
            "facility_type": "level",
            "latitude": "latitude",
            "longitude": "longitude",
        },
        optional={
            "ownership_raw": "ownership",
            "ownership_detail": "authority",
            "admin2": "district",
            "status": "status",
            "open_date_raw": "opening_date",
        },
    ),
    "zambia": Source(
        data_source="Zambia Ministry of Health Master Facility List (MFL)",
        required={
            "facility_name": "Name",
            "facility_code": "MFL_Code",
            "admin1": "Province",
            "facility_type": "Type",
            "latitude": "Latitude",
            "longitude": "Longitude",
        },
        optional={
            "ownership_raw": "Ownership",
            "ownership_detail": "Ownership type",
            "admin2": "District",
            "zone": "Zone",
            "status": "Operational_status",
            "catchment_population": "Catchment population head count",
        },
    ),
    "nigeria": Source(
        data_source="GRID3 Nigeria Health Facilities v2.0 (derived from NHFR)",
        required={
            "facility_name": "facility_name",
            "facility_code": "nhfr_facility_code",
            "admin1": "state",
            "facility_type": "facility_level",
            "latitude": "latitude",
            "longitude": "longitude",
        },
        optional={"ownership_raw": "ownership", "admin2": "lga"},
    ),
    "botswana": Source(
        data_source="Botswana Ministry of Health Facilities List 2026",
        required={
            "facility_name": "Facility Name",
            "facility_code": "New Facility Code",
            "admin1": "District",
            "facility_type": "Service Delivery Type",
            "latitude": "Latitude",
            "longitude": "Longitude",
        },
        optional={"ownership_raw": "Facility Owner", "status": "Facility Status"},
    ),
    "kenya": Source(
        data_source="Kenya Master Health Facility Registry (KMHFR) 2026",
        required={
            "facility_name": "facility_name",
            "facility_code": "facility_code",
            "admin1": "admin1",
            "facility_type": "facility_type",
            "latitude": "latitude",
            "longitude": "longitude",
        },
        optional={"ownership_raw": "facility_ownership", "status": "status"},
    ),
    "ethiopia": Source(
        data_source=(
            "Ethiopia MoH Master Facility Registry v2 (https://mfrv2.moh.gov.et); "
            "coordinates joined from HDX/WHO AFRO 2024"
        ),
        required={
            "facility_name": "facility_name",
            "facility_code": "facility_code",
            "admin1": "admin1",
            "facility_type": "facility_type",
            "latitude": "latitude",
            "longitude": "longitude",
        },
        optional={
            "ownership_raw": "facility_ownership",
            "admin2": "admin2",
            "status": "status",
        },
    ),
}

# Crosswalk keys and source columns of each service list.
FEEDS = {
    "TZA": Feed(
        country_name="Tanzania",
        join_keys=(("service_category", "source_category"), ("service_detail", "source_detail")),
        source_category_id="service_category",
        source_service_name="service_detail",
    ),
    "MWI": Feed(
        country_name="Malawi",
        join_keys=(("service_name", "source_service_name"),),
        source_service_id="service_id",
        source_type_id="service_type_id",
        source_category_id="service_category_id",
        source_service_name="service_name",
        date_column="created_date",
    ),
    "BWA": Feed(
        country_name="Botswana",
        join_keys=(("service_category", "source_category"), ("service_name", "source_service_name")),
        source_category_id="service_category",
        source_service_name="service_name",
    ),
    "KEN": Feed(
        country_name="Kenya",
        join_keys=(("service_category", "source_category"), ("service_detail", "source_service_name")),
        source_category_id="service_category",
        source_service_name="service_detail",
    ),
    "ETH": Feed(
        country_name="Ethiopia",
        join_keys=(("service_category", "source_category"), ("service_name", "source_service_name")),
        source_category_id="service_category",
        source_service_name="service_name",
    ),
}


def check_known(requested, known=SOURCES) -> list[str]:
    """The requested names, or all known ones; unknown names are an error."""
    if requested is None:
        return list(known)
    unknown = [name for name in requested if name not in known]
    if unknown:
        raise ValueError(f"unknown countries: {', '.join(unknown)}")
    return list(requested)
