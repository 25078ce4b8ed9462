import datetime as dt
import warnings

import pytest
from pyspark.sql import functions as F

from registry_spark.countries import SOURCES, Box, Source, check_known
from registry_spark.operators import columns, coordinates, merging, profiles, quality, typing
from registry_spark.schema import FACILITY_FIELDS, SERVICE_FIELDS, Field, struct_type

REQUIRED = {
    "facility_name": "name", "facility_code": "code", "admin1": "region",
    "facility_type": "kind", "latitude": "lat", "longitude": "lon",
}


def test_column_map(frame):
    df = frame([("A", "1", "R", "K", "1", "2", "LGA", "Public", "x", "old", "e")],
               "` name ` string, code string, region string, kind string, lat string, lon string,"
               "ownership string, group string, Zone string, country string, extra string")
    source = Source("Label", REQUIRED, {"ownership_detail": "ownership", "ownership_raw": "group"})
    out = columns.standardize_columns(columns.trim_column_names(df), "kenya", source)
    row = out.first().asDict()
    assert row["facility_name"] == "A" and row["ownership_detail"] == "LGA" and row["ownership"] == "Public"
    assert row["country"] == "Kenya" and row["data_source"] == "Label"
    assert row["Zone"] == "x" and row["extra"] == "e" and "code" not in out.columns


def test_column_map_missing_columns(frame):
    df = frame([("A", "1", "R", "K", "1")], "name string, code string, region string, kind string, lat string")
    with pytest.raises(ValueError, match=r"'lon' missing.*'longitude'"):
        columns.standardize_columns(df, "kenya", Source("L", REQUIRED))
    full = df.withColumn("lon", F.lit("2"))
    with pytest.warns(UserWarning, match="'d' not found"):
        out = columns.standardize_columns(full, "kenya", Source("L", REQUIRED, {"admin2": "d"}))
    assert "admin2" not in out.columns
    assert out.first()["ownership"] is None


def test_raw_column_named_like_another_standard_one(frame):
    df = frame([("short", "long", "1", "R", "K", "1", "2", "raw")],
               "name string, facility_name string, code string, region string, kind string, lat string, lon string,"
               "Zone string")
    source = Source("L", REQUIRED, {"zone": "region"})
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        out = columns.standardize_columns(df, "kenya", source).first().asDict()
    assert out["facility_name"] == "short" and out["facility_name_source"] == "long"
    assert out["zone"] == "R" and out["Zone_source"] == "raw"


def test_ownership(values):
    inputs = ["Local GOVERNMENT", "Parastatal", "Church", "Private NGO", "For Profit", "clinic", "Govt", "", None]
    assert values(inputs, columns.classify_ownership) == [
        "Public", "Public", "Faith-Based / NGO", "Faith-Based / NGO", "Private", "Private", "Other", "Other", "Other"]


def test_every_source_maps_the_required_fields():
    for source in SOURCES.values():
        assert set(source.required) == set(REQUIRED)


def test_unknown_country():
    assert check_known(None) == list(SOURCES)
    with pytest.raises(ValueError, match="atlantis"):
        check_known(["kenya", "atlantis"])


def coords(frame, rows):
    return frame(rows, "country string, latitude string, longitude string")


def test_coordinates_on_and_off_the_box(frame):
    rows = [("Kenya", "-5", "33"), ("Kenya", "6", "42"), ("Kenya", "6.0001", "40"), ("Kenya", "40", "1"),
            ("kenya", "0", "36"), ("Nowhere", "80", "170"), ("Nowhere", "91", "0"), ("Nowhere", "0", "-181"),
            (None, "1", "1")]
    out = coordinates.clean_coordinates(coords(frame, rows)).collect()
    assert [r.coordinate_valid for r in out] == [True, True, False, False, True, True, False, False, True]


def test_missing_coordinates_dropped_or_kept(frame):
    rows = [("Kenya", None, "36"), ("Kenya", "", "36"), ("Kenya", "12,5", "36"), ("Kenya", "NaN", "36"), ("Kenya", "0", "36")]
    df = coords(frame, rows)
    assert coordinates.clean_coordinates(df).count() == 1
    kept = coordinates.clean_coordinates(df, on_missing="keep").collect()
    assert [r.coordinate_valid for r in kept] == [None] * 4 + [True]
    with pytest.raises(ValueError):
        coordinates.clean_coordinates(df, on_missing="guess")


def test_own_boxes(frame):
    df = coords(frame, [("Here", "5", "5"), ("Here", "15", "5")])
    out = coordinates.clean_coordinates(df, boxes={"here": Box(0, 10, 0, 10)}).collect()
    assert [r.coordinate_valid for r in out] == [True, False]
    assert coordinates.clean_coordinates(df, boxes={}).filter("coordinate_valid").count() == 2


@pytest.mark.parametrize("method", ["broadcast", "shuffle", "auto"])
def test_geocode_cache(frame, method):
    df = frame([("A", " R ", "Kenya", None, None), ("B", None, "Kenya", None, 1.0), ("C", "R", "Kenya", None, None),
                ("D", "R", "Kenya", 1.0, 2.0)],
               "facility_name string, admin1 string, country string, latitude double, longitude double")
    cache = frame([("A, R, Kenya", None, None, None), ("A, R, Kenya", 3.0, 4.0, "clinic"), ("B, Kenya", None, None, None)],
                  "query string, result_lat double, result_lon double, result_type string")
    out = {r.facility_name: r for r in coordinates.fill_from_cache(df, cache, method=method).collect()}
    assert (out["A"].latitude, out["A"].longitude, out["A"].coordinate_source) == (3.0, 4.0, "OSM")
    assert out["A"].geocode_status == "cached" and out["B"].geocode_status == "failed"
    assert out["C"].geocode_status == "pending" and out["D"].geocode_status is None
    assert out["D"].latitude == 1.0 and out["D"].coordinate_source is None
    failures = coordinates.geocode_failures(coordinates.fill_from_cache(df, cache, method=method))
    assert [r.geocode_query for r in failures.collect()] == ["B, Kenya"]


def test_clean_dates(frame):
    df = frame([("12apr2005",), ("1850-06-01",), ("2090-01-01",), ("01jan1970",)], "open_date_raw string")
    out = quality.clean_dates(df, current_year=2026).collect()
    assert [r.open_year for r in out] == [2005, None, None, None]
    assert [r.open_date is None for r in out] == [False, False, False, True]
    strict = quality.clean_dates(df, current_year=2026, null_implausible=True).collect()
    assert [r.open_date is None for r in strict] == [False, True, True, True]
    absent = quality.clean_dates(frame([("x",)], "other string"))
    assert absent.columns == ["other", "open_date", "open_year"]
    assert absent.first().open_date is None


def test_enforce_schema(frame):
    fields = (Field("code"), Field("lat", "float"), Field("n", "integer"), Field("flag", "boolean"),
              Field("day", "date"), Field("absent", "boolean"))
    df = frame([("000123", "1.5", "12.7", "Y", "2024-01-05", "kept"), ("100000", "x", "3e9", None, "bad", None)],
               "code string, lat string, n string, flag string, day string, extra string")
    out = typing.enforce_schema(df, fields)
    assert out.columns == ["code", "lat", "n", "flag", "day", "absent", "extra"]
    assert [tuple(r) for r in out.collect()] == [
        ("000123", 1.5, 12, True, dt.date(2024, 1, 5), None, "kept"), ("100000", None, None, False, None, None, None)]
    rejects = {r.column_name: r.rejected for r in typing.count_rejects(df, fields).collect()}
    assert rejects == {"lat": 1, "n": 1, "day": 1}


def test_enforce_schema_twice_changes_nothing(frame):
    df = frame([("1", "2.5", "yes")], "facility_code string, latitude string, inpatient string")
    once = typing.enforce_schema(df, FACILITY_FIELDS)
    twice = typing.enforce_schema(once, FACILITY_FIELDS)
    assert once.schema == twice.schema and once.collect() == twice.collect()


def test_schema_carries_contracts():
    schema = struct_type(FACILITY_FIELDS)
    assert len(schema.fields) == 28 and len(struct_type(SERVICE_FIELDS).fields) == 19
    assert schema["latitude"].metadata["max"] == 90 and schema["facility_code"].metadata["unique"]


def test_contract(frame):
    df = frame([("a", "x", 5.0), ("a", "y", 50.0), (None, None, -1.0), ("b", "z", None)],
               "k string, v string, n double")
    fields = (Field("k", required=True, unique=True), Field("v", allowed=("x", "y")),
              Field("n", "float", low=0, high=10), Field("absent", required=True))
    out = {(r.column_name, r.rule): r.violations for r in typing.check_contract(df, fields).collect()}
    assert out == {("k", "required"): 1, ("k", "unique"): 1, ("v", "allowed"): 1, ("n", "range"): 2}
    empty = {r.rule: r.violations for r in typing.check_contract(df.limit(0), fields).collect()}
    assert set(empty.values()) == {0}


def test_quality_flag_branches(frame):
    rows = [
        (None, 1.0, True, "n", "t", "o", "low"), (1.0, None, True, "n", "t", "o", "low"),
        (1.0, 1.0, False, "n", "t", "o", "low"), (1.0, 1.0, True, None, "t", "o", "low"),
        (1.0, 1.0, True, "n", "t", "o", "high"), (1.0, 1.0, True, "n", None, "o", "medium"),
        (1.0, 1.0, True, "n", "t", None, "medium"), (1.0, 1.0, None, "n", "t", "o", "unknown"),
        (1.0, 1.0, None, None, "t", "o", "low"),
    ]
    df = frame(rows, "latitude double, longitude double, coordinate_valid boolean, facility_name string,"
                     "facility_type string, ownership string, want string")
    for r in quality.flag_data_quality(df).collect():
        assert r.data_quality_flag == r.want


def test_merge_fills_the_country_and_keeps_extras(frame):
    one = frame([("1", None, "a")], "facility_code string, country string, ward string")
    two = frame([("2", "Kenya", "7")], "facility_code string, country string, catchment_population string")
    out = merging.merge_countries({"malawi": one, "uganda": two}, dt.date(2026, 1, 31))
    rows = {r.facility_code: r for r in out.collect()}
    assert rows["1"].country == "Malawi" and rows["2"].country == "Kenya"
    assert rows["2"].catchment_population == 7 and rows["2"].ward is None and rows["1"].ward == "a"
    assert {r.extraction_date for r in rows.values()} == {dt.date(2026, 1, 31)}
    with pytest.raises(ValueError):
        merging.merge_countries({})


def test_completeness_and_distribution(frame):
    df = frame([("a", None), ("a", None), (None, None)], "x string, `y z` string")
    out = {r.column_name: (r.non_null, r.n_rows, r.pct_non_null) for r in profiles.completeness(df).collect()}
    assert out == {"x": (2, 3, 66.7), "y z": (0, 3, 0.0)}
    assert [tuple(r) for r in profiles.distribution(df, "x").collect()] == [("a", 2, 66.7)]
    empty = {r.column_name: r.pct_non_null for r in profiles.completeness(df.limit(0)).collect()}
    assert empty == {"x": None, "y z": None}


def test_quality_by_country(frame):
    df = frame([("K", "high")] * 2 + [("K", None), ("M", "low")], "country string, data_quality_flag string")
    out = sorted(tuple(r) for r in profiles.quality_by_country(df).collect())
    assert out == [("K", "(null)", 1, 33.3), ("K", "high", 2, 66.7), ("M", "low", 1, 100.0)]
