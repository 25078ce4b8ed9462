import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from registry_spark.countries import FEEDS
from registry_spark.operators import crosswalks, generators, merging, profiles
from registry_spark.plans.services import standardize_services
from registry_spark.schema import SERVICE_FIELDS
from registry_spark.vocabularies import CATEGORY_RULES, NAME_RULES

# name -> (domain, group, clinical, include) by the ordered rules, in a clinical category
GOLDEN = {
    "ANC": ("Reproductive & Maternal Health", "Reproductive & Maternal Health Services", True, True),
    "Maternal health": ("Reproductive & Maternal Health", "Reproductive & Maternal Health Services", True, True),
    "Family planning": ("Reproductive & Maternal Health", "Family Planning", True, True),
    "Preparations of medicine": ("HIV/AIDS Services", "HIV/AIDS Services", True, True),
    "Open heart repair": ("HIV/AIDS Services", "HIV/AIDS Services", True, True),  # "art" before a space
    "ART": ("HIV/AIDS Services", "HIV/AIDS Services", True, True),
    "TB": ("Clinical Services", "TB Services", True, True),
    "Malaria RDT": ("Malaria Services", "Malaria Diagnosis and Treatment", True, True),
    "Vaccination": ("Community & Preventive Health", "Immunisation/Vaccination", True, True),
    "Pharmacy": ("Support Services", "Therapeutics and Pharmacy", False, False),
    "Minor Surgery": ("Clinical Services", "Surgical Services", True, True),
    "Cardiac ICU": ("Clinical Services", "General Inpatient (IPD)", True, True),
    "Waste management": ("Clinical Services", "ENT Services", True, True),
    "X-ray": ("Diagnostic Services", "Radiology Services", True, True),
    "CT": ("Diagnostic Services", "Radiology Services", True, True),
    "Gram stain": ("Diagnostic Services", "Laboratory Services", True, True),
    "EEG": ("Diagnostic Services", "Diagnostic Services", True, True),
    "Autopsy": ("Support Services", "Support Services", False, False),
    "24 hours OPD": ("Support Services", "Service Hours", False, False),
    "Others": ("Support Services", "Support Services", False, False),
    "Something else": ("Clinical Services", "General Clinical Services", True, True),
}


def test_name_rules_golden(frame):
    df = frame([("clinical_services", n) for n in GOLDEN], "service_category string, service_name string")
    out = {r.service_name: r for r in crosswalks.crosswalk_from_names(df).collect()}
    for name, want in GOLDEN.items():
        r = out[name]
        assert (r.service_domain, r.service_group, r.is_clinical, r.include_in_analysis) == want, name
    assert out["Others"].needs_review and not out["ANC"].needs_review
    assert out["Malaria RDT"].is_malaria_related and not out["TB"].is_malaria_related


def test_category_defaults(frame):
    cats = ["clinical_services", "diagnostic_services", "support_services", "twenty_four_hour", "unknown", None]
    df = frame([(c, "zzz") for c in cats], "service_category string, service_name string")
    out = {r.source_category: r for r in crosswalks.crosswalk_from_names(df).collect()}
    assert out["twenty_four_hour"].service_group == "Service Hours"
    assert out["support_services"].is_clinical is False and out["diagnostic_services"].is_clinical is True
    assert out["unknown"].service_domain is None and out[None].service_domain is None


def test_exact_rules(frame):
    df = frame([("FAMILY PLANNING", "Pills"), ("MORTUARY SERVICES", "RDT for Malaria"), ("NEW ONE", "act first line"),
                ("NEW ONE", "Other"), ("FAMILY PLANNING", None)], "service_category string, service_detail string")
    pairs = crosswalks.vocabulary(df, ["service_category", "service_detail"], drop_nulls=True)
    out = {(r.source_category, r.source_service_name): r for r in crosswalks.crosswalk_from_categories(pairs).collect()}
    assert len(out) == 4
    r = out["FAMILY PLANNING", "Pills"]
    assert (r.service_group, r.is_malaria_related, r.needs_review) == ("Family Planning", False, False)
    r = out["MORTUARY SERVICES", "RDT for Malaria"]
    assert (r.service_domain, r.is_clinical, r.is_malaria_related) == ("Malaria Services", False, True)
    r = out["NEW ONE", "act first line"]
    assert (r.service_domain, r.is_malaria_related, r.needs_review) == ("Malaria Services", True, True)
    r = out["NEW ONE", "Other"]
    assert (r.service_domain, r.is_malaria_related, r.needs_review) == (None, None, True)


def test_rule_tables():
    assert len(NAME_RULES) == 29 and len(CATEGORY_RULES) == 50
    assert len({r.category for r in CATEGORY_RULES}) == 50


CW = "source_category string, source_detail string, service_domain string, service_group string, service_name string," \
     "is_clinical boolean, is_malaria_related boolean, include_in_analysis boolean, needs_review boolean"
KEYS = (("service_category", "source_category"), ("service_detail", "source_detail"))


@pytest.fixture
def cw(frame):
    return frame([
        ("c1", " HIV \\u0026 TB ", "D1", "G1", "N1", True, False, True, False),
        ("c1", None, "D2", "G2", None, True, False, None, False),
        ("c2", "Santé", "D3", "G3", "N3", False, True, True, True),
        ("c2", "Santé ", "D3", "G3", "N3", False, True, True, True),
    ], CW)


@pytest.mark.parametrize("method", ["broadcast", "shuffle", "auto"])
def test_translate(frame, cw, method):
    facts = frame([(1, "c1\t", "HIV \\u0026 TB", "raw"), (2, " c1", None, "raw"), (3, "c2", "\tSanté\n", "raw"),
                   (4, "c2", None, "raw"), (5, None, None, "raw"), (6, "c1", "HIV & TB", "raw")],
                  "i int, service_category string, service_detail string, service_group string")
    out = {r.i: r for r in crosswalks.translate(facts, cw, KEYS, method=method).collect()}
    assert len(out) == 6
    assert (out[1].service_domain, out[1].service_group, out[1].service_name) == ("D1", "G1", "N1")
    assert (out[2].service_domain, out[2].service_name, out[2].include_in_analysis) == ("D2", None, None)
    assert out[3].service_domain == "D3" and out[3].needs_review
    assert all(out[i].service_domain is None and out[i].service_group is None for i in (4, 5, 6))
    filled = crosswalks.translate(facts, cw, KEYS, fallback_to_source="service_detail", method=method)
    names = {r.i: r.service_name for r in filled.collect()}
    assert names[1] == "N1" and names[6] == "HIV & TB"


def test_missing_names_and_master_vocabulary(frame, cw):
    facts = frame([("c1", "new"), ("c1 ", "new "), ("c1", None), ("c2", "Santé")],
                  "service_category string, service_detail string")
    assert [tuple(r) for r in crosswalks.missing_names(facts, cw, KEYS).collect()] == [("c1", "new")]
    master = crosswalks.union_crosswalks({"TZA": cw, "KEN": cw.drop("needs_review")})
    assert Counter(r.country_iso for r in master.collect()) == {"TZA": 4, "KEN": 4}


def test_crosswalk_quality(frame, cw):
    out = {(r.measure, r.value): r.n for r in profiles.crosswalk_quality(cw).collect()}
    assert out[("domain", "D1")] == 1 and out[("include_in_analysis", "(null)")] == 1
    assert out[("needs_review", "true")] == 2 and ("without_rule", "c1") not in out


def test_split_lists(frame):
    df = frame([("1", "A; B  b ;;", None, "", "X"), ("2", None, ";", "D", None)],
               "`Facility ID` string, `Clinical Services` string, `Support Services` string,"
               "`Diagnostic Services` string, `24Hr Services` string")
    out = sorted(map(tuple, generators.split_lists(df, "Facility ID").collect()))
    assert out == [("1", "clinical_services", "A"), ("1", "clinical_services", "B b"),
                   ("1", "twenty_four_hour", "X"), ("2", "diagnostic_services", "D")]


PAYLOAD = """[
 {"id": "i1", "newFacilityCode": "", "facilityName": "A", "lat": "-24.5", "lng": 25.75, "isAlwaysOpen": true,
  "district": {"name": "South"}, "facilityServices": [{"name": "OPD"}, {"name": ""}, {"name": null}],
  "knownYesNoInfrastructures": [{"type": "Water", "available": true}, {"type": "Power", "isAvailable": false}],
  "facilityInfrastructures": [
    {"quantity": 3, "facilityInfrastructureType": {"type": "Nurse", "staff": true, "available": true}},
    {"facilityInfrastructureType": {"type": "Bed", "isAvailable": true}},
    {"quantity": "many", "facilityInfrastructureType": {"type": "Car", "isAvailable": true}},
    {"quantity": 9, "facilityInfrastructureType": {"type": null, "isAvailable": true}}]},
 {"id": "i2", "newFacilityCode": "N2", "lat": "unknown", "facilityServices": []},
 {"id": "i3"}]"""


def test_payload(spark, tmp_path):
    from registry_spark.sources.readers import read_payload

    (tmp_path / "dump.json").write_text(PAYLOAD)
    payload = read_payload(spark, str(tmp_path / "dump.json"))
    fac = {r["New Facility Code"]: r for r in generators.payload_facilities(payload).collect()}
    assert set(fac) == {"i1", "N2", "i3"}
    assert (fac["i1"].Latitude, fac["i1"].Longitude, fac["i1"].District) == (-24.5, 25.75, "South")
    assert fac["i1"]["Always Open"] is True and fac["i3"]["Always Open"] is False and fac["N2"].Latitude is None
    out = sorted(map(tuple, generators.payload_services(payload).collect()))
    assert out == [
        ("i1", "clinical_services", "OPD", None, True), ("i1", "infrastructure", "Bed", 0, True),
        ("i1", "infrastructure", "Car", None, True), ("i1", "infrastructure", "Water", None, True),
        ("i1", "staff", "Nurse", 3, True)]


def test_standardize_services(frame, cw):
    raw = frame([("000123", "c1", "HIV \\u0026 TB", "g"), ("100000", "c1", None, "g"), ("x", "c9", "q", "g"),
                 (None, "c2", "Santé", "g"), ("000123", "c1", "HIV \\u0026 TB", "g")],
                "facility_code string, service_category string, service_detail string, service_group string")
    registry = frame([("TZA", "000123", "TZA-000001", None), ("TZA", "000123", "TZA-000009", None),
                      ("KEN", "100000", "KEN-000002", None)],
                     "country string, facility_code string, uid string, created_date date")
    out = standardize_services(raw, "TZA", FEEDS["TZA"], cw, registry, source_url="tz.csv")
    assert out.columns == [f.name for f in SERVICE_FIELDS]
    rows = out.collect()
    assert len(rows) == 5
    assert sorted(r.uid for r in rows) == [f"TZA-SVC-{i:06d}" for i in range(1, 6)]
    by_code = {r.facility_code: r for r in rows}
    assert by_code["000123"].facility_uid == "TZA-000001" and by_code["100000"].facility_uid is None
    assert by_code["000123"].source_service_name == "HIV \\u0026 TB" and by_code["000123"].service_name == "N1"
    assert by_code["100000"].service_domain == "D2" and by_code["x"].service_domain is None
    assert by_code["x"].source_category_id == "c9" and by_code["x"].source_service_id is None
    assert {r.country_name for r in rows} == {"Tanzania"} and {r.source_url for r in rows} == {"tz.csv"}

    report = profiles.service_report(out).first().asDict()
    assert report == {"total_records": 5, "unique_facilities": 4, "matched_uid": 2, "unmatched_uid": 3,
                      "included": 3, "to_review": 1, "pct_matched": 40.0}
    assert [tuple(r) for r in profiles.unmatched_report(out).collect()] == [("x", "q", 0)]
    nothing = profiles.service_report(out.limit(0)).first()
    assert nothing.total_records == 0 and nothing.pct_matched is None and nothing.unique_facilities == 0


def test_services_with_one_key_and_dates(frame, cw):
    feed = FEEDS["MWI"]
    raw = frame([("7", "s1", "4", "0", "Santé", "2026-05-20T08:09:10Z"), ("7", "s2", "4", "0", "Autre", None)],
                "facility_code string, service_id string, service_type_id string, service_category_id string,"
                "service_name string, created_date string")
    names = cw.filter("source_category = 'c2'").limit(1).withColumnRenamed("source_detail", "source_service_name")
    registry = frame([], "country string, facility_code string, uid string, created_date date")
    out = {r.source_service_id: r for r in standardize_services(raw, "MWI", feed, names, registry).collect()}
    assert out["s1"].service_name == "N3" and out["s1"].extracted_date == dt.date(2026, 5, 20)
    assert out["s1"].source_service_name == "Santé"
    assert out["s2"].service_name is None and out["s2"].source_service_name == "Autre"
    assert out["s2"].extracted_date is None and out["s2"].facility_uid is None


def test_unmatched_report_counts_the_rest(frame):
    df = frame([(f"f{i:03d}", "n", None) for i in range(60)] * 2, "facility_code string, source_service_name string, service_domain string")
    out = profiles.unmatched_report(df).orderBy("facility_code").collect()
    assert len(out) == 50 and {r.n_more for r in out} == {10} and out[0].facility_code == "f000"


def test_facilities_with_services(frame):
    fac = frame([("U1", "A", 1.0, 2.0, "K"), (None, "B", 1.0, 2.0, "K"), ("U3", None, None, None, "K")],
                "uid string, facility_name string, latitude double, longitude double, country string")
    svc = frame([("U1", "s1", "d"), ("U1", "s2", "d"), (None, "s3", "d"), ("U9", "s4", "d"), ("U3", "s5", "d")],
                "facility_uid string, service_name string, service_domain string")
    out = profiles.facilities_with_services(fac, svc)
    assert sorted(r.service_name for r in out.collect()) == ["s1", "s2", "s5"]


def test_merge_services(frame):
    one = frame([("u", 5, "x")], "uid string, source_service_id int, extra string")
    two = frame([("v", "7")], "uid string, source_service_id string")
    out = merging.merge_services([one, two])
    assert out.columns == ["uid", "source_service_id"]
    assert sorted(map(tuple, out.collect())) == [("u", "5"), ("v", "7")]


def test_orphans_and_malaria(frame):
    svc = frame([("KEN", "a", True, True), ("KEN", "b", True, None), ("KEN", "b", False, True), ("KEN", None, True, True)],
                "country_iso string, facility_code string, is_malaria_related boolean, include_in_analysis boolean")
    reg = frame([("KEN", "a"), ("MWI", "b")], "country string, facility_code string")
    assert [tuple(r) for r in profiles.orphan_codes(svc, reg).collect()] == [("KEN", "b", 2)]
    assert profiles.malaria_services(svc).count() == 2
    assert profiles.included(svc).filter(F.col("facility_code") == "b").count() == 1
