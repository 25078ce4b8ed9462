import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from registry_spark.plans.everything import run_all
from registry_spark.plans.extracts import located_list
from registry_spark.plans.facilities import LakePaths, run_facilities
from registry_spark.plans.reports import facility_reports, service_reports, stored_reports
from registry_spark.schema import FACILITY_FIELDS, UID_REGISTRY
from registry_spark.sources import lake, readers
from registry_spark.sources.runlog import RunLog, counters_path, failed_steps
from registry_spark.sources.shared import shared_folder, written


def test_text_csv(spark, tmp_path):
    path = tmp_path / "r.CSV"
    path.write_bytes(' code , name,n\n000123,"Sant\xe9, ""x""",NA\n100000,,""\n'.encode("latin-1"))
    rows = readers.read_registry(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [("000123", 'Santé, "x"', None), ("100000", None, None)]
    assert readers.read_registry(spark, str(path)).columns == ["code", "name", "n"]
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_registry(spark, str(tmp_path / "r.xlsx"))


def test_crosswalk_csv(spark, tmp_path):
    (tmp_path / "cw.csv").write_text(
        "source_category,source_detail,service_domain,is_clinical,include_in_analysis\n"
        "c1, Spaced\t,D,TRUE,NA\nc1,NA,D,FALSE,TRUE\n")
    rows = readers.read_crosswalk(spark, str(tmp_path / "cw.csv")).collect()
    assert [tuple(r) for r in rows] == [("c1", "Spaced", "D", True, None), ("c1", None, "D", False, True)]


def test_missing_state_table_is_empty(spark, tmp_path):
    df = readers.read_uid_registry(spark, str(tmp_path / "none"))
    assert df.schema == UID_REGISTRY and df.count() == 0


def test_partitions_are_replaced_one_by_one(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    lake.write_country_tables(frame([("a", "Kenya"), ("b", "Malawi")], "v string, country string"), path)
    lake.write_country_tables(frame([("c", "Kenya")], "v string, country string"), path)
    out = sorted((r.country, r.v) for r in readers.read_standardized(spark, path).collect())
    assert out == [("Kenya", "c"), ("Malawi", "b")]


def test_csv_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    lake.write_country_tables(frame([(' a "b"', "Kenya")], "v string, country string"), path, "csv")
    assert [r.v for r in readers.read_text_csv(spark, f"{path}/country=Kenya").collect()] == [' a "b"']


def test_written_table(spark, frame):
    df = frame([("a", 1), (None, 2)], "k string, n int")
    kept = written(df)
    assert kept.schema == df.schema and sorted(r.n for r in kept.collect()) == [1, 2]
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_snapshots_keep_earlier_months(spark, frame, tmp_path):
    path = str(tmp_path / "s")
    lake.write_snapshot(frame([("old",)], "v string"), path, dt.date(2026, 4, 3))
    lake.write_snapshot(frame([("first",)], "v string"), path, dt.date(2026, 5, 1))
    written = lake.write_snapshot(frame([("second",)], "v string"), path, dt.date(2026, 5, 20))
    assert written.endswith("snapshot_month=2026-05")
    out = sorted((r.snapshot_month, r.v) for r in spark.read.parquet(path).collect())
    assert out == [("2026-04", "old"), ("2026-05", "second")]


def test_size_saving(spark, tmp_path):
    df = spark.range(50000).select((F.col("id") % 7).cast("string").alias("v"))
    df.coalesce(1).write.parquet(str(tmp_path / "p"))
    df.coalesce(1).write.csv(str(tmp_path / "c"))
    out = lake.size_saving(spark, str(tmp_path / "p"), str(tmp_path / "c")).first()
    assert 0 < out.snapshot_mb < out.text_mb and out.pct_smaller > 50


def test_run_log(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    log.add("kenya", "extract", "START")
    log.flush()
    log.add("kenya", "extract", "FAILED", ValueError("no file"))
    log.add("malawi", "extract", "SUCCESS")
    log.flush()
    log.flush()
    written = spark.read.parquet(str(tmp_path / "log"))
    assert written.count() == 3 and written.columns == ["timestamp", "country", "step", "status", "message"]
    assert [(r.country, r.step, r.n) for r in failed_steps(written).collect()] == [("kenya", "extract", 1)]
    assert log.failed() == ["kenya"]


KENYA = """facility_code,facility_name,admin1,facility_type,facility_ownership,latitude,longitude,status,ward
100000,Alpha,Nairobi,Clinic,Private,-1.2,36.8,Open,w1
000123,Beta,Mombasa,Hospital,Ministry (MOH),-4.0,39.6,Open,w2
000123,Beta,Mombasa,Hospital,Ministry (MOH),-4.0,39.6,Open,w2
,Gamma,Mombasa,Hospital,Mission,-4.1,39.7,Open,w3
77,Delta,Kisumu,Hospital,Mission,,,Open,w4
78,Epsilon,Kisumu,Hospital,Mission,36.8,-1.2,Open,w5
"""
MALAWI = """facility_code,facility_name,admin1,facility_type,facility_ownership,latitude,longitude,status,zone nr
1,Mzuzu,North,Hospital,Government,-11.4,34.0,Open,9
"""
SERVICES = """facility_code,service_category,service_group,service_detail
100000,FAMILY PLANNING,FAMILY PLANNING,Pills
000123,CURATIVE SERVICES,CURATIVE SERVICES,Malaria care
999,CURATIVE SERVICES,CURATIVE SERVICES,Unknown
100000,FAMILY PLANNING,FAMILY PLANNING,Pills
"""
CROSSWALK = """source_category,source_service_name,service_domain,service_group,service_name,is_clinical,is_malaria_related,include_in_analysis,needs_review
FAMILY PLANNING,Pills,Reproductive & Maternal Health,Family Planning,Pills,TRUE,FALSE,TRUE,FALSE
CURATIVE SERVICES,Malaria care,Malaria Services,Malaria Diagnosis and Treatment,Malaria care,TRUE,TRUE,TRUE,FALSE
"""


@pytest.fixture
def inputs(tmp_path):
    paths = {}
    for name, body in (("kenya", KENYA), ("malawi", MALAWI), ("services", SERVICES), ("crosswalk", CROSSWALK)):
        (tmp_path / f"{name}.csv").write_text(body)
        paths[name] = str(tmp_path / f"{name}.csv")
    return paths


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_whole_run_twice(spark, inputs, tmp_path):
    root = str(tmp_path / "lake")
    raw = {"kenya": inputs["kenya"], "malawi": inputs["malawi"], "uganda": str(tmp_path / "missing.csv")}
    args = (spark, raw, {"KEN": (inputs["services"], inputs["crosswalk"]), "MWI": ("missing.csv", "missing.csv")}, root)
    out = run_all(*args, countries=["kenya", "malawi", "uganda"], run_date=dt.date(2026, 5, 20))

    fac = out["facilities"]
    assert set(f.name for f in FACILITY_FIELDS) <= set(fac.columns) and {"ward", "zone nr"} <= set(fac.columns)
    rows = {(r.facility_code, r.facility_name): r for r in fac.collect()}
    assert fac.count() == 6
    uids = {k: r.uid for k, r in rows.items()}
    assert uids["000123", "Beta"].startswith("KEN-") and uids[None, "Gamma"] is None
    assert uids["1", "Mzuzu"] == "MWI-000001"
    assert rows["78", "Epsilon"].data_quality_flag == "low" and rows["100000", "Alpha"].data_quality_flag == "high"
    assert rows["000123", "Beta"].ownership == "Public" and rows["100000", "Alpha"].extraction_date == dt.date(2026, 5, 20)

    summary = {(r.country, r.data_quality_flag): (r.n_facilities, r.pct_of_country) for r in out["summary"].collect()}
    assert summary == {("Kenya", "high"): (4, 80.0), ("Kenya", "low"): (1, 20.0), ("Malawi", "high"): (1, 100.0)}

    for name, report in {**facility_reports(fac), **service_reports(out["services"])}.items():
        assert report.count() > 0, name
    broken = {(r.column_name, r.rule): r.violations for r in facility_reports(fac)["contract"].collect()}
    assert broken["facility_code", "unique"] == 1 and broken["facility_code", "required"] == 1
    assert broken["country", "allowed"] == 0 and broken["latitude", "range"] == 0

    svc = out["services"].collect()
    assert len(svc) == 4 and sum(r.facility_uid is not None for r in svc) == 3
    assert spark.read.parquet(LakePaths(root).slim_services).count() == 4
    assert {"health_facilities", "facility_services"} <= set(lake.list_tables(spark))

    failed = {(r.country, r.step) for r in failed_steps(spark.read.parquet(LakePaths(root).log)).collect()}
    assert failed == {("uganda", "pipeline"), ("GLOBAL", "services MWI")}

    def counters(step, country):
        found = spark.read.parquet(counters_path(LakePaths(root).log)).filter((F.col("step") == step) & (F.col("country") == country))
        return {r.counter: r.n for r in found.orderBy("timestamp").collect()}

    assert counters("services", "KEN") == {"rows": 4, "matched": 3, "unmatched": 1}
    kenya = counters("facilities", "kenya")
    assert (kenya["rows"], kenya["minted"], kenya["reused"], kenya["skipped"]) == (5, 3, 0, 1)
    assert counters("boundary", "kenya") == {"outside": 0}
    stored = stored_reports(spark, LakePaths(root).counters)
    assert {(r.country, r.data_quality_flag): (r.n_facilities, r.pct_of_country) for r in stored["quality"].collect()} == summary
    wanted = {(r.country, r.column_name): r.non_null for r in facility_reports(fac)["completeness"].collect()}
    kept = {(r.country, r.column_name): r.non_null for r in stored["completeness"].collect()}
    assert len(kept) > 30 and {k: (n, wanted[k]) for k, n in kept.items() if wanted[k] != n} == {}

    again = run_all(*args, countries=["kenya", "malawi"], run_date=dt.date(2026, 6, 1), with_services=False)
    assert {(r.facility_code, r.facility_name): r.uid for r in again["facilities"].collect()} == uids
    kenya = counters("facilities", "kenya")
    assert (kenya["minted"], kenya["reused"]) == (0, 3)
    registry = readers.read_uid_registry(spark, LakePaths(root).registry)
    assert registry.count() == registry.select("country", "facility_code").distinct().count() == 4
    months = {r.snapshot_month for r in spark.read.parquet(LakePaths(root).snapshots).collect()}
    assert months == {"2026-05", "2026-06"}


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_cache_and_boundary_in_the_country_step(spark, inputs, frame, tmp_path):
    cache = str(tmp_path / "cache")
    lake.append_rows(frame([("Delta, Kisumu, Kenya", -0.1, 34.75, "clinic")],
                           "query string, result_lat double, result_lon double, result_type string"), cache)
    corners = [(33.0, -3.0), (40.0, -3.0), (40.0, 3.0), (33.0, 3.0)]
    edges = frame([("Kenya", *a, *b) for a, b in zip(corners, [*corners[1:], corners[0]])],
                  "country string, x1 double, y1 double, x2 double, y2 double")
    out = run_facilities(spark, {"kenya": inputs["kenya"]}, LakePaths(str(tmp_path / "lake")), countries=["kenya"],
                         run_date=dt.date(2026, 5, 20), cache_path=cache, edges=edges)
    rows = {r.facility_name: r for r in out.collect()}
    assert set(rows) == {"Alpha", "Delta"}
    assert rows["Delta"].coordinate_source == "OSM" and rows["Delta"].coordinate_valid
    log = spark.read.parquet(counters_path(LakePaths(str(tmp_path / "lake")).log))
    assert [r.n for r in log.filter("counter = 'outside'").collect()] == [4]


def test_nothing_readable_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no country"):
        run_facilities(spark, {}, LakePaths(str(tmp_path / "lake")), countries=["kenya"])


def test_payload_lines(spark, tmp_path):
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"id": str(i)}) for i in range(3)))
    assert readers.read_payload(spark, str(tmp_path / "lines.json"), multi_line=False).count() == 3


def test_located_list(frame):
    names = ("Facility ID", "Facility Name", "Facility Type", "Ownership", "Region", "Zone", "Woreda", "Operational Status")
    schema = ", ".join(f"`{n}` string" for n in names)
    source = frame([("1", "B", "t", "o", "r", "z", "w", "s"), ("1", "A", "t", "o", "r", "z", "w", "s"),
                    ("2", "C", "t", "o", "r", "z", "w", "s")], schema)
    points = frame([(1, -1.5, 36.5), (1, -1.6, 36.5), (3, 0.0, 0.0)], "Id int, Latitude double, Longitude double")
    out = {r.facility_code: r for r in located_list(source, points, order_by=["facility_name"]).collect()}
    assert len(out) == 2 and out["1"].facility_name == "A" and out["1"].latitude == -1.6
    assert out["2"].latitude is None and out["2"].admin3 == "w" and out["2"].facility_ownership == "o"
