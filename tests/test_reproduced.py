"""Cases that once lost or changed data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from registry_spark.countries import Source
from registry_spark.operators import crosswalks, identifiers, profiles, typing
from registry_spark.operators.numbering import number_rows
from registry_spark.plans.facilities import LakePaths, run_facilities
from registry_spark.schema import FACILITY_FIELDS, UID_REGISTRY, Field
from registry_spark.sources import lake, readers
from registry_spark.sources.runlog import RunLog

HEAD = "facility_code,facility_name,admin1,facility_type,facility_ownership,latitude,longitude,status,iso\n"
RWANDA = Source("Registry of Rwanda", {
    "facility_name": "facility_name", "facility_code": "facility_code", "admin1": "admin1", "facility_type": "facility_type",
    "latitude": "latitude", "longitude": "longitude",
}, {"ownership_raw": "facility_ownership", "status": "status"})
DAY = dt.date(2026, 5, 20)


def facility(code, name="A", lat="-2.0", iso="raw"):
    return f"{code},{name},North,Clinic,Public,{lat},30.0,Open,{iso}\n"


@pytest.mark.parametrize("code", ["KE", "ke", "KEN", "K1", "x"])
def test_numbers_go_on_for_any_country_code(spark, frame, code):
    known = spark.createDataFrame([(code, "a", f"{code}-000001", DAY)], UID_REGISTRY)
    fac = frame([(code, "a"), (code, "b")], "iso string, facility_code string")
    new = identifiers.new_registry_rows(fac, known, DAY).collect()
    assert [(r.facility_code, r.uid) for r in new] == [("b", f"{code}-000002")]


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_own_country_and_raw_iso_column(spark, tmp_path):
    (tmp_path / "rwanda.csv").write_text(HEAD + facility("1", iso="from source"))
    paths = LakePaths(str(tmp_path / "lake"))
    out = run_facilities(
        spark, {"rwanda": str(tmp_path / "rwanda.csv")}, paths, countries=["rwanda"], sources={"rwanda": RWANDA}, codes={"rwanda": "RWA"}, run_date=DAY
    ).collect()
    assert [(r.uid, r.iso, r.country) for r in out] == [("RWA-000001", "from source", "Rwanda")]


def test_country_without_code_is_a_failed_step(spark, tmp_path):
    (tmp_path / "rwanda.csv").write_text(HEAD + facility("1"))
    log = RunLog(spark)
    with pytest.raises(ValueError, match="no country"):
        run_facilities(spark, {"rwanda": str(tmp_path / "rwanda.csv")}, LakePaths(str(tmp_path / "lake")), countries=["rwanda"],
                       sources={"rwanda": RWANDA}, run_date=DAY, log=log)
    assert log.failed() == ["GLOBAL", "rwanda"]


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_damaged_file_stops_its_country_only(spark, tmp_path):
    (tmp_path / "kenya.csv").write_text(HEAD + '1,"Clinic\nNorth",North,Clinic,Public,-2.0,36.0,Open,x\n')
    (tmp_path / "malawi.csv").write_text(HEAD + facility("1", lat="-12.0").replace("30.0", "34.0"))
    raw = {c: str(tmp_path / f"{c}.csv") for c in ("kenya", "malawi")}
    log = RunLog(spark)
    out = run_facilities(spark, raw, LakePaths(str(tmp_path / "lake")), countries=["kenya", "malawi"], run_date=DAY, log=log)
    assert [r.country for r in out.collect()] == ["Malawi"] and log.failed() == ["kenya"]
    whole = run_facilities(spark, raw, LakePaths(str(tmp_path / "other")), countries=["kenya"], run_date=DAY, read_options={"multi_line": True})
    assert [r.facility_name for r in whole.collect()] == ["Clinic\nNorth"]


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_country_that_lost_all_rows(spark, tmp_path):
    paths, raw = LakePaths(str(tmp_path / "lake")), {}
    for country, lat, lon in (("kenya", "-2.0", "36.0"), ("malawi", "-12.0", "34.0")):
        raw[country] = str(tmp_path / f"{country}.csv")
        (tmp_path / f"{country}.csv").write_text(HEAD + facility("1", lat=lat).replace("30.0", lon))
    assert run_facilities(spark, raw, paths, countries=["kenya", "malawi"], run_date=DAY).count() == 2
    (tmp_path / "malawi.csv").write_text(HEAD + facility("1", lat=""))
    spark.catalog.clearCache()
    again = run_facilities(spark, raw, paths, countries=["kenya", "malawi"], run_date=DAY)
    assert [r.country for r in again.collect()] == ["Kenya"]


def test_numeric_flags_and_codes(frame):
    fields = (Field("facility_code"), Field("inpatient", "boolean"))
    out = typing.enforce_schema(frame([(100000.0, 1.0), (2.5, 0.0), (None, None)], "facility_code double, inpatient double"), fields)
    assert [tuple(r) for r in out.collect()] == [("100000", True), ("2.5", False), (None, False)]


@pytest.mark.parametrize("collapse", [True, False])
def test_bucket_width_changes_no_number(spark, collapse):
    df = spark.range(2_000).select(F.col("id").cast("string").alias("k"))
    numbers = [{r.k: r.n for r in number_rows(df, ["k"], digits=d, collapse=collapse).collect()} for d in (1, 2, 4)]
    assert numbers[0] == numbers[1] == numbers[2] and sorted(numbers[0].values()) == list(range(1, 2_001))


def test_code_used_in_two_countries(frame):
    df = frame([("1", "Kenya"), ("1", "Malawi"), ("2", "Kenya"), ("2", "Kenya")], "facility_code string, country string")
    out = {(r.column_name, r.rule): r.violations for r in typing.check_contract(df, FACILITY_FIELDS).collect()}
    assert out["facility_code", "unique"] == 1


def test_conflicting_crosswalk_keys(frame):
    cw = frame([("a", "x", "D1"), ("a", "x", "D2"), ("a", "y", "D1"), ("a", "y", "D1"), (None, None, "D")],
               "source_category string, source_service_name string, service_domain string")
    out = profiles.conflicting_keys(cw, ["source_category", "source_service_name"]).collect()
    assert [tuple(r) for r in out] == [("a", "x", 2)]


def test_table_moves_without_a_gap(spark, frame, tmp_path):
    for month, value in (("05", "a"), ("06", "b")):
        frame([(value,)], "v string").write.parquet(str(tmp_path / month))
        lake.point_table(spark, "moved_table", str(tmp_path / month))
        assert [r.v for r in spark.table("moved_table").collect()] == [value]
    frame([(1, "c")], "n int, v string").write.parquet(str(tmp_path / "07"))
    lake.point_table(spark, "moved_table", str(tmp_path / "07"))
    assert spark.table("moved_table").columns == ["n", "v"]
    spark.sql("DROP TABLE moved_table")


def test_ragged_records(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_text_csv(spark, str(tmp_path / "x.csv")).select("a").collect()
    rows = readers.read_text_csv(spark, str(tmp_path / "x.csv"), mode="PERMISSIVE").collect()
    assert [tuple(r) for r in rows] == [("1", "2"), ("3", None)]


def test_crosswalk_uses_the_smallest_of_two_rows(frame):
    cw = frame([("a", "D2"), ("a", "D1")], "k string, service_domain string")
    out = crosswalks.translate(frame([("a",)], "c string"), cw, (("c", "k"),)).collect()
    assert [r.service_domain for r in out] == ["D1"]
