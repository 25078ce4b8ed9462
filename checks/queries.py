"""One registered query per operator, each over whole tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from checks import tables as t
from registry_spark.countries import Feed, Source
from registry_spark.functions.dates import date_of_iso_datetime
from registry_spark.operators import boundaries, columns, coordinates, crosswalks, generators
from registry_spark.operators import identifiers, lookups, merging, partials, profiles, quality, rings, rule_index, typing
from registry_spark.plans import extracts
from registry_spark.plans import facilities as facility_plan
from registry_spark.plans import reports
from registry_spark.plans import services as service_plan
from registry_spark.schema import FACILITY_FIELDS, SERVICE_FIELDS, SLIM_SERVICE_COLUMNS, Field
from registry_spark.session import more_partitions
from registry_spark.sources import geometry, lake, readers, runlog
from registry_spark.sources.shared import shared_folder, written
from registry_spark.vocabularies import NAME_RULES

THIS_YEAR = 2026
RUN_DATE = dt.date(2026, 1, 31)
KEYS = (("service_category", "source_category"), ("service_detail", "source_detail"))

SOURCE = Source(
    data_source="Customer registry",
    required={
        "facility_name": "facility_name", "facility_code": "facility_code", "admin1": "admin1",
        "facility_type": "facility_type", "latitude": "latitude", "longitude": "longitude",
    },
    optional={
        "ownership_raw": "ownership_raw", "admin2": "admin2", "status": "status",
        "open_date_raw": "open_date_raw", "catchment_population": "catchment_population",
    },
)


# -- facilities ---------------------------------------------------------------

def owned(spark, d):
    fac = t.raw_facilities(spark, d)
    return fac.withColumn("ownership", columns.classify_ownership(F.col("ownership_raw")))


def valid(spark, d):
    return coordinates.clean_coordinates(owned(spark, d), on_missing="keep")


def flagged(spark, d):
    return quality.flag_data_quality(valid(spark, d))


def lake_summary(spark, d):
    return profiles.quality_by_country(flagged(spark, d))


def standardize_columns(spark, d):
    raw = t.read(spark, d, "customer").withColumn("Facility Name", F.col("c_name")).drop("c_name")
    raw = raw.withColumn("ownership", F.col("c_mktsegment"))
    source = Source("Customer table", {
        "facility_name": "Facility Name", "facility_code": "c_custkey", "admin1": "c_nationkey",
        "facility_type": "c_mktsegment", "latitude": "c_acctbal", "longitude": "c_acctbal",
    }, {"ownership_detail": "ownership"})
    out = columns.standardize_columns(columns.trim_column_names(raw), "kenya", source)
    return out.select("facility_code", "facility_name", "admin1", "facility_type", "latitude",
                      "ownership_detail", "ownership", "country", "data_source")


def ownership_class(spark, d):
    return owned(spark, d).select("source_row", "ownership_raw", "ownership")


def coord_clean(spark, d):
    out = coordinates.clean_coordinates(t.raw_facilities(spark, d))
    return out.select("source_row", "country", "latitude", "longitude", "coordinate_valid")


def coord_clean_keep(spark, d):
    return valid(spark, d).select("source_row", "country", "latitude", "longitude", "coordinate_valid")


def date_clean(spark, d):
    out = quality.clean_dates(t.raw_facilities(spark, d), current_year=THIS_YEAR)
    return out.select("source_row", "open_date", "open_year")


def date_clean_strict(spark, d):
    out = quality.clean_dates(t.raw_facilities(spark, d), current_year=THIS_YEAR, null_implausible=True)
    return out.select("source_row", "open_date", "open_year")


def iso_datetime(spark, d):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return t.read(spark, d, "orders").select("o_orderkey", date_of_iso_datetime(text).alias("extracted_date"))


TYPED = (
    Field("facility_code"), Field("latitude", "float"), Field("catchment_population", "integer"),
    Field("inpatient", "boolean"), Field("outpatient", "boolean"), Field("open_date", "date"), Field("zone"),
)


def enforce_schema(spark, d):
    raw = t.raw_facilities(spark, d).withColumn("open_date", F.col("open_date_raw"))
    out = typing.enforce_schema(raw, TYPED)
    return out.select("source_row", *[f.name for f in TYPED])


def schema_rejects(spark, d):
    raw = t.raw_facilities(spark, d).withColumn("open_date", F.col("open_date_raw"))
    return typing.count_rejects(raw, TYPED)


def quality_flag(spark, d):
    return flagged(spark, d).select("source_row", "coordinate_valid", "data_quality_flag")


def quality_distribution(spark, d):
    return profiles.distribution(flagged(spark, d), "data_quality_flag")


def within_filter(spark, d):
    out = boundaries.filter_within(
        coordinates.drop_missing(valid(spark, d)), t.boundary_edges(spark), method="broadcast")
    return out.select("source_row", "country", "latitude", "longitude", "coordinate_valid")


def within_flag_large(spark, d):
    """Boundaries too large to broadcast."""
    out = boundaries.flag_within(valid(spark, d), t.boundary_edges(spark), method="shuffle")
    return out.select("source_row", "country", "coordinate_valid")


def within_flag(spark, d):
    out = boundaries.flag_within(valid(spark, d), t.boundary_edges(spark), method="broadcast")
    return out.select("source_row", "country", "coordinate_valid")


def within_flag_sphere(spark, d):
    """Boundaries whose edges are arcs of great circles."""
    out = boundaries.flag_within(valid(spark, d), t.boundary_edges(spark), surface="sphere")
    return out.select("source_row", "country", "coordinate_valid")


def within_sphere_world(spark, d):
    """Points all over the globe against large polygons over the date line and the poles."""
    return boundaries.spherical.with_verdict(t.world_points(spark, d), t.world_edges(spark)).drop("latitude", "longitude")


def within_flag_geojson(spark, d):
    """Boundaries as a GeoJSON file, a feature a line."""
    path = f"{shared_folder(spark)}/bounds"
    t.boundary_features(spark).write.text(path)
    edges = rings.edge_table(geometry.read_geojson(spark, path, "name", one_document=False))
    out = boundaries.flag_within(valid(spark, d), edges)
    return out.select("source_row", "country", "coordinate_valid")


def polygon_edges(spark, d):
    """Edges of polygons with holes and islands given as WKT and GeoJSON."""
    texts = t.polygon_texts(spark, d)
    wkt = geometry.wkt_rings(texts.filter("document NOT LIKE '{%'"), "document", keep=["country"])
    features = geometry.geojson_features(texts.filter("document LIKE '{%'"), "document").select(
        F.col("properties")["key"].alias("country"), "geometry")
    return rings.edge_table(wkt.unionByName(geometry.geojson_rings(features, "geometry", keep=["country"])))


def ring_problems(spark, d):
    """What is wrong with each of many rings given as WKT."""
    found = geometry.wkt_rings(t.ring_texts(spark, d), "document", keep=["country"])
    return rings.ring_report(found, keep=["country"])


def geocode_cache(spark, d):
    out = coordinates.fill_from_cache(
        coordinates.coerce_coordinates(t.raw_facilities(spark, d)), t.geocode_cache(spark, d))
    return out.select("source_row", "geocode_query", "geocode_status", "latitude", "longitude", "coordinate_source")


def geocode_failures(spark, d):
    out = coordinates.fill_from_cache(
        coordinates.coerce_coordinates(t.raw_facilities(spark, d)), t.geocode_cache(spark, d), method="shuffle")
    return coordinates.geocode_failures(out).select("source_row", "geocode_query")


def coord_lookup(spark, d):
    """First order per customer code, then its coordinates where known."""
    first = lookups.first_per_key(
        t.read(spark, d, "orders").select(
            F.col("o_custkey").cast("string").alias("facility_code"), "o_orderkey", "o_orderstatus"),
        ["facility_code"], ["o_orderkey"])
    known = coordinates.coerce_coordinates(t.raw_facilities(spark, d)).select(
        F.col("source_row").cast("string").alias("Id"), "latitude", "longitude")
    return lookups.lookup_join(first, known, [("facility_code", "Id")])


def geocode_pending(spark, d):
    out = coordinates.fill_from_cache(
        coordinates.coerce_coordinates(t.raw_facilities(spark, d)), t.geocode_cache(spark, d))
    return coordinates.geocode_pending(out)


def located_list(spark, d):
    """Orders as a facility export with repeated codes, located by a second list."""
    export = t.read(spark, d, "orders").select(
        F.col("o_custkey").alias("Facility ID"), F.expr("'F' || o_custkey").alias("Facility Name"),
        F.col("o_orderpriority").alias("Facility Type"), F.col("o_orderstatus").alias("Ownership"),
        F.lit("R").alias("Region"), F.lit("Z").alias("Zone"), F.col("o_orderkey").alias("Woreda"),
        F.lit("Open").alias("Operational Status"))
    points = coordinates.coerce_coordinates(t.raw_facilities(spark, d)).select(
        F.col("source_row").alias("Id"), F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"))
    return extracts.located_list(export, points, order_by=["admin3"])


def union_merge(spark, d):
    fac = t.raw_facilities(spark, d)
    one = fac.filter("balance < 4000").select(
        "facility_code", "facility_name", "source_row", F.lit(None).cast("string").alias("country"))
    two = fac.filter("balance >= 4000").select(
        "facility_code", "country", "catchment_population", "source_row", F.col("admin2").alias("ward"))
    out = merging.merge_countries({"nigeria": one, "malawi": two}, RUN_DATE)
    return out.select("source_row", "facility_code", "facility_name", "country", "catchment_population",
                      "latitude", "inpatient", "ward", "extraction_date")


def completeness(spark, d):
    return profiles.completeness(t.raw_facilities(spark, d))


def step_counters(spark, d):
    dated = quality.clean_dates(valid(spark, d), current_year=THIS_YEAR).withColumn("uid", F.col("facility_code"))
    return dated.agg(*[c for group in profiles.step_counters().values() for c in group])


def contract_facilities(spark, d):
    out = typing.enforce_schema(flagged(spark, d).drop("ownership_raw"), FACILITY_FIELDS)
    return typing.check_contract(written(out), FACILITY_FIELDS)


def completeness_by_country(spark, d):
    return profiles.completeness(t.raw_facilities(spark, d).select("country", "facility_name", "latitude"), by="country")


def country_counts(spark, d):
    return profiles.counts_by(t.raw_facilities(spark, d), "country", name="facilities")


# -- identifiers --------------------------------------------------------------

def uid_highest(spark, d):
    return identifiers.highest_numbers(t.registry(spark, d))


def uid_new(spark, d):
    return identifiers.new_registry_rows(t.raw_facilities(spark, d), t.registry(spark, d), RUN_DATE)


def uid_reuse_mint(spark, d):
    fac, known = t.raw_facilities(spark, d), t.registry(spark, d)
    minted = identifiers.new_registry_rows(fac, known, RUN_DATE)
    out = identifiers.assign_uids(fac, known.unionByName(minted), method="shuffle")
    return out.select("source_row", "iso", "facility_code", "uid")


def any_code(column):
    return F.expr(f"CASE WHEN {column} < 'M' THEN lower(substr({column}, 1, 2)) ELSE substr({column}, 1, 2) END")


def uid_reuse_mint_any_code(spark, d):
    """Codes of two letters, some in lower case, with numbers given out before."""
    fac = t.raw_facilities(spark, d).withColumn("iso", any_code("iso"))
    path = shared_folder(spark)
    lake.append_rows(t.registry(spark, d).withColumn("country", any_code("country")), path)
    known = facility_plan.register_new(spark, fac, path, RUN_DATE, country="iso")
    return identifiers.assign_uids(fac, known).select("source_row", "iso", "facility_code", "uid")


def service_uid(spark, d):
    out = identifiers.service_uids(t.raw_services(spark, d), "TZA", t.SERVICE_ORDER)
    return out.select(*t.SERVICE_ORDER, "facility_code", "uid")


def facility_uid_join(spark, d):
    out = identifiers.assign_uids(
        t.raw_services(spark, d), t.registry(spark, d), country="country_iso", name="facility_uid")
    return out.select(*t.SERVICE_ORDER, "facility_code", "country_iso", "facility_uid")


def facility_uid_join_bucketed(spark, d):
    """Identifiers from a registry kept in buckets, and from the rows given out since it was written."""
    known = t.registry(spark, d).withColumn("late", F.expr("created_date >= DATE'2024-11-01'"))
    base = lake.bucketed_table(known.filter("NOT late").drop("late"), "uid_registry_bucketed", ["country", "facility_code"],
                               int(spark.conf.get("spark.sql.shuffle.partitions")), f"{shared_folder(spark)}/registry")
    out = identifiers.assign_uids_layered(
        t.raw_services(spark, d), base, known.filter("late").drop("late"), country="country_iso", name="facility_uid")
    return out.select(*t.SERVICE_ORDER, "facility_code", "country_iso", "facility_uid")


def facility_uid_join_skewed(spark, d):
    """The same join on the path for lookups too large to broadcast."""
    out = identifiers.assign_uids(
        t.raw_services(spark, d), t.registry(spark, d), country="country_iso", name="facility_uid", method="shuffle")
    return out.select(*t.SERVICE_ORDER, "facility_code", "country_iso", "facility_uid")


def orphan_codes(spark, d):
    return profiles.orphan_codes(t.raw_services(spark, d), t.registry(spark, d))


# -- services -----------------------------------------------------------------

def joined(spark, d):
    facts = t.raw_services(spark, d).withColumn(
        "source_service_name", F.btrim("service_detail", F.lit(" \t\r\n")))
    out = crosswalks.translate(facts, t.crosswalk(spark, d), KEYS)
    return identifiers.assign_uids(out, t.registry(spark, d), country="country_iso", name="facility_uid")


HIERARCHY = ["service_domain", "service_group", "service_name"]
FLAGS = ["is_clinical", "is_malaria_related", "include_in_analysis", "needs_review"]


def crosswalk_two_key(spark, d):
    out = crosswalks.translate(t.raw_services(spark, d), t.crosswalk(spark, d), KEYS)
    return out.select(*t.SERVICE_ORDER, *HIERARCHY, *FLAGS)


def crosswalk_two_key_skewed(spark, d):
    out = crosswalks.translate(t.raw_services(spark, d), t.crosswalk(spark, d), KEYS, method="shuffle")
    return out.select(*t.SERVICE_ORDER, *HIERARCHY, *FLAGS)


def crosswalk_one_key(spark, d):
    """Single-key crosswalk by name, the source name standing in where it has none."""
    names = t.crosswalk(spark, d).drop("source_category")
    out = crosswalks.translate(
        t.raw_services(spark, d).withColumn("raw_name", F.trim("service_detail")), names,
        (("service_detail", "source_detail"),), fallback_to_source="raw_name")
    return out.select(*t.SERVICE_ORDER, "service_domain", "service_group", "service_name")


def crosswalk_unmatched(spark, d):
    return profiles.unmatched_pairs(joined(spark, d))


def unmatched_report(spark, d):
    return profiles.unmatched_report(joined(spark, d))


def crosswalk_gap(spark, d):
    return crosswalks.missing_names(t.raw_services(spark, d), t.crosswalk(spark, d), KEYS)


def rule_exact(spark, d):
    pairs = t.read(spark, d, "part").select(
        F.expr("""CASE p_type WHEN 'STANDARD' THEN 'HIV TREATMENT' WHEN 'ECONOMY' THEN 'MORTUARY SERVICES'
            WHEN 'SMALL' THEN 'ANTENATAL CARE' WHEN 'LARGE' THEN 'THEATRE SERVICES'
            WHEN 'PROMO' THEN 'UNKNOWN SERVICES' END""").alias("service_category"),
        F.expr("CASE WHEN p_name LIKE '% gizmo' THEN 'mRDT ' || p_name ELSE p_name END").alias("service_detail"))
    vocabulary = crosswalks.vocabulary(pairs, ["service_category", "service_detail"], drop_nulls=True)
    return crosswalks.crosswalk_from_categories(vocabulary)


def rule_first_match(spark, d):
    """Ordered name rules over whole document texts."""
    docs = lookups.spread(t.read(spark, d, "documents").select("doc_id", "text"))
    category = F.expr("""CASE doc_id % 5 WHEN 0 THEN 'clinical_services' WHEN 1 THEN 'support_services'
        WHEN 2 THEN 'diagnostic_services' WHEN 3 THEN 'twenty_four_hour' ELSE 'other' END""")
    out = crosswalks.with_name_rules(docs.select("doc_id", "text", category.alias("category")), "category", "text")
    return out.select("doc_id", "service_domain", "service_group", "is_clinical", "include_in_analysis")


def rule_names(spark, d):
    """Ordered name rules over the distinct vocabulary, as a crosswalk."""
    pairs = t.read(spark, d, "part").select(
        F.expr("CASE WHEN p_size % 2 = 0 THEN 'clinical_services' ELSE 'support_services' END").alias("service_category"),
        F.expr("""CASE p_size % 6 WHEN 0 THEN p_name || ' Surgery' WHEN 1 THEN 'ANC ' || p_name
            WHEN 2 THEN p_name || ' management' WHEN 3 THEN 'Malaria ' || p_name WHEN 4 THEN 'Error ' || p_name
            ELSE p_name END""").alias("service_name"))
    return crosswalks.crosswalk_from_names(
        crosswalks.vocabulary(pairs, ["service_category", "service_name"]))


def rule_table(spark, d):
    """Name rules kept as a table."""
    table = spark.createDataFrame(
        [(i, r.pattern, r.domain, r.group) for i, r in enumerate(NAME_RULES)],
        "rule_id int, pattern string, service_domain string, service_group string")
    docs = lookups.spread(t.read(spark, d, "documents").select("doc_id", "text"))
    out = crosswalks.with_name_rules(
        docs.withColumn("category", F.lit("clinical_services")), "category", "text", rules=crosswalks.name_rules(table))
    return out.select("doc_id", "service_domain", "service_group", "is_clinical", "include_in_analysis")


def rules_indexed(spark, d):
    """Rules that the data give, one a name and one a brand, looked up by their fragments."""
    part = t.read(spark, d, "part")
    by_name = part.groupBy("p_name").agg(F.min("p_partkey").alias("rule_id")).select(
        "rule_id", F.concat(F.lit(r"\b"), "p_name", F.lit(" (economy|large|promo).*#1[0-9]?$|^none "), "p_name").alias("pattern"),
        F.upper("p_name").alias("domain"))
    by_brand = part.groupBy("p_brand").agg((F.min("p_partkey") + 1_000_000_000).alias("rule_id")).select(
        "rule_id", F.concat(F.lower("p_brand"), F.lit("$")).alias("pattern"), F.col("p_brand").alias("domain"))
    rules = by_name.unionByName(by_brand).filter("rule_id % 5 <> 0")
    named = part.select("p_partkey", "p_type", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("name"))
    defaults = part.select("p_type").distinct().filter("p_type <> 'ECONOMY'").withColumn("domain", F.lower("p_type"))
    return rule_index.with_rule_table(named, "name", rules, defaults=defaults, on="p_type")


def crosswalk_built(spark, d):
    """Crosswalk of the service list's vocabulary, written and read back."""
    services = t.read(spark, d, "part").select(
        F.expr("CASE WHEN p_size % 2 = 0 THEN 'clinical_services' ELSE 'support_services' END").alias("service_category"),
        F.expr("""CASE p_size % 6 WHEN 0 THEN p_name || ' Surgery' WHEN 1 THEN 'ANC ' || p_name
            WHEN 2 THEN p_name || ' management' WHEN 3 THEN 'Malaria ' || p_name WHEN 4 THEN 'Error ' || p_name
            ELSE p_name END""").alias("service_name"))
    return extracts.build_crosswalk(services, f"{shared_folder(spark)}/crosswalk", category="service_category", name="service_name")


def payload_prepared(spark, d):
    """Payload to registry and service list on disk; the registry as read back."""
    registry, _ = extracts.prepare_payload(payload(spark, d), shared_folder(spark))
    return registry.withColumnsRenamed({c: c.lower().replace(" ", "_").replace("-", "_") for c in registry.columns})


def wide_prepared(spark, d):
    """Wide list to located registry and items on disk; the items as read back."""
    wide = t.read(spark, d, "part").select(
        F.col("p_partkey").alias("Facility ID"), F.col("p_name").alias("Facility Name"), F.col("p_type").alias("Facility Type"),
        F.lit("Public").alias("Ownership"), F.lit("R").alias("Region"), F.lit("Z").alias("Zone"), F.col("p_brand").alias("Woreda"),
        F.lit("Open").alias("Operational Status"), F.expr("p_name || ';' || p_type").alias("Clinical Services"),
        F.expr("CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE ' ' || p_brand || '  x ;; ' || p_name || ';' END").alias("Support Services"),
        F.expr("CASE WHEN p_size < 25 THEN '' ELSE p_type END").alias("Diagnostic Services"),
        F.expr("'Open ' || p_size").alias("24Hr Services"))
    points = coordinates.coerce_coordinates(t.raw_facilities(spark, d)).select(
        F.col("source_row").alias("Id"), F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"))
    _, items = extracts.prepare_wide_list(wide, points, shared_folder(spark))
    return items


def vocab_inventory(spark, d):
    return crosswalks.vocabulary(
        t.raw_services(spark, d), ["service_category", "service_detail"], drop_nulls=True
    ).orderBy("service_category", "service_detail")


def vocab_union(spark, d):
    cw = t.crosswalk(spark, d)
    return crosswalks.union_crosswalks({
        "TZA": cw,
        "KEN": cw.drop("needs_review").withColumn("source_group", F.col("service_group")),
    })


def crosswalk_qa(spark, d):
    return profiles.crosswalk_quality(t.crosswalk(spark, d), ["source_detail"])


def service_report(spark, d):
    return profiles.service_report(joined(spark, d))


def domain_distribution(spark, d):
    return profiles.distribution(joined(spark, d), "service_domain")


def domain_counts(spark, d):
    out = profiles.counts_by(profiles.included(joined(spark, d)), "service_domain")
    return out.orderBy(F.desc("n"), "service_domain")


def malaria_counts(spark, d):
    facts = joined(spark, d).withColumnRenamed("country_iso", "country_name")
    return profiles.malaria_counts(facts).orderBy("country_name", F.desc("facilities"), "service_group", "service_name")


def source_profile(spark, d):
    return profiles.source_profile(
        t.raw_services(spark, d), "facility_code",
        {"n_names": "service_detail", "n_categories": "service_category"}, located="service_detail")


def category_counts(spark, d):
    return profiles.counts_by(t.raw_services(spark, d), "service_category")


def table_rows(spark, d):
    return t.raw_services(spark, d).agg(F.count(F.lit(1)).alias("n"))


def contract_services(spark, d):
    facts = joined(spark, d).withColumn("uid", F.col("l_orderkey").cast("string"))
    return typing.check_contract(written(facts.select(*[f.name for f in SERVICE_FIELDS if f.name in facts.columns])), SERVICE_FIELDS)


def located(spark, d):
    """Registered facilities with coordinates."""
    fac = identifiers.assign_uids(coordinates.coerce_coordinates(t.raw_facilities(spark, d)), t.registry(spark, d))
    return fac.select("uid", "facility_name", "latitude", "longitude", "country")


def facility_service_join(spark, d):
    return profiles.facilities_with_services(
        located(spark, d), profiles.malaria_services(joined(spark, d)))


def facility_service_hot(spark, d):
    """Services of which one facility holds a third."""
    fac = coordinates.coerce_coordinates(t.raw_facilities(spark, d)).filter("facility_code <> ''").withColumnRenamed("facility_code", "uid")
    code = F.when(F.col("l_orderkey") % 3 == 0, F.lit("7")).otherwise(F.col("facility_code"))
    services = t.raw_services(spark, d).select(
        *t.SERVICE_ORDER, code.alias("facility_uid"), F.col("service_detail").alias("service_name"),
        F.col("service_category").alias("service_domain"))
    return profiles.facilities_with_services(fac, services)


def facility_service_top(spark, d):
    """The first 20 malaria services with their facility."""
    return profiles.facilities_with_services(
        located(spark, d), profiles.malaria_services(joined(spark, d))
    ).orderBy("country", "facility_name", "service_name", "service_domain", "latitude", "longitude").limit(20)


# -- generators ---------------------------------------------------------------

def split_explode(spark, d):
    return generators.split_lists(
        t.read(spark, d, "documents"), "doc_id", {"text": "clinical_services"}, separator="\n")


def split_lists(spark, d):
    part = t.read(spark, d, "part").select(
        F.col("p_partkey").alias("Facility ID"),
        F.expr("p_name || ';' || p_type").alias("Clinical Services"),
        F.expr("CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE ' ' || p_brand || '  x ;; ' || p_name || ';' END")
        .alias("Support Services"),
        F.expr("CASE WHEN p_size < 25 THEN '' ELSE p_type END").alias("Diagnostic Services"),
        F.expr("'Open ' || p_size").alias("24Hr Services"))
    return generators.split_lists(part, "Facility ID")


def json_props(spark, d):
    events = t.read(spark, d, "events")
    parsed = F.from_json("props", "k int").getField("k")
    return events.select("event_id", "event_type", parsed.alias("k"))


PAYLOAD_TEXT = """to_json(named_struct(
  'id', concat('c', conv_id, '-', turn),
  'newFacilityCode', CASE WHEN turn % 3 = 0 THEN '' WHEN turn % 3 = 1 THEN concat('N', conv_id, '-', turn) END,
  'oldFacilityCode', concat('old ', role), 'constituency', named_struct('name', concat('c', conv_id)),
  'facilityType', CASE WHEN turn % 2 = 1 THEN named_struct('name', concat('type ', turn)) END,
  'telephone', concat('+', conv_id), 'isUrbanOrRural', CASE turn % 3 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Rural' END,
  'status', 'open', 'facilityStatus', concat('published ', turn), 'catchmentArea', CAST(conv_id AS STRING),
  'updated', concat('2026-01-0', 1 + turn % 9),
  'facilityName', CASE WHEN turn % 5 <> 4 THEN role END,
  'district', CASE WHEN turn % 2 = 0 THEN named_struct('name', role) END,
  'physicalAddress', named_struct('district', named_struct('name', role)),
  'facilityOwner', role, 'lat', concat(conv_id % 90, '.5'), 'lng', CASE WHEN turn % 2 = 0 THEN 'east' ELSE '30' END,
  'isAlwaysOpen', CASE turn % 3 WHEN 0 THEN true WHEN 1 THEN false END,
  'facilityServices', transform(split(text, '\\n'), x -> named_struct('name', x)),
  'knownYesNoInfrastructures', array(
     named_struct('type', 'Water', 'isAvailable', turn % 2 = 0, 'available', CAST(NULL AS BOOLEAN)),
     named_struct('type', 'Power', 'isAvailable', CAST(NULL AS BOOLEAN), 'available', conv_id % 2 = 0)),
  'facilityInfrastructures', array(
     named_struct('quantity', CAST(turn AS STRING), 'facilityInfrastructureType',
        named_struct('type', 'Nurse', 'isStaff', turn % 2 = 0, 'isAvailable', true)),
     named_struct('quantity', CASE WHEN turn % 2 = 0 THEN 'many' END, 'facilityInfrastructureType',
        named_struct('type', CASE WHEN conv_id % 3 = 0 THEN 'Bed' END, 'isStaff', CAST(NULL AS BOOLEAN),
                     'isAvailable', conv_id % 2 = 1)))))"""


def payload(spark, d):
    """Conversation turns as nested facility objects, through their JSON text."""
    text = t.read(spark, d, "conversations").select(F.expr(PAYLOAD_TEXT).alias("body"))
    return text.select(F.from_json("body", generators.PAYLOAD).alias("f")).select("f.*")


def payload_facilities(spark, d):
    out = generators.payload_facilities(payload(spark, d))
    names = {c: c.lower().replace(" ", "_").replace("-", "_") for c in out.columns}
    return out.withColumnsRenamed(names)


def payload_services(spark, d):
    return generators.payload_services(payload(spark, d))


# -- whole plans --------------------------------------------------------------

def facilities_plan(spark, d):
    """Raw registry to typed, flagged facilities, boundary and dates included."""
    out = facility_plan.standardize_country(
        t.raw_facilities(spark, d).withColumnRenamed("country", "place"), "tanzania", SOURCE,
        current_year=THIS_YEAR)
    return out.select("source_row", "facility_code", "facility_name", "country", "admin1", "latitude", "longitude",
                      "coordinate_valid", "facility_type", "ownership", "status", "open_date", "open_year",
                      "catchment_population", "inpatient", "data_source", "data_quality_flag")


FEED = Feed("Tanzania", KEYS, source_service_name="service_detail", source_category_id="service_category",
            source_service_id="l_partkey")


def services_plan(spark, d):
    """Raw service list to the 19 published columns."""
    return service_plan.standardize_services(
        t.raw_services(spark, d), "TZA", FEED, t.crosswalk(spark, d), t.registry(spark, d),
        source_url="services.csv", order_by=t.SERVICE_ORDER)


def services_plan_large(spark, d):
    """The same with lookups too large to broadcast."""
    return service_plan.standardize_services(
        t.raw_services(spark, d), "TZA", FEED, t.crosswalk(spark, d), t.registry(spark, d),
        source_url="services.csv", order_by=t.SERVICE_ORDER, method="shuffle")


def services_slim(spark, d):
    return services_plan(spark, d).select(*SLIM_SERVICE_COLUMNS)


# -- sources and sinks --------------------------------------------------------

def csv_registry(spark, d):
    """Registry written as CSV text, with line breaks and quotes in names, and read back: every value stays as written."""
    path = f"{shared_folder(spark)}/registry.csv"
    annex = F.expr("""CASE WHEN source_row % 5 = 0 THEN facility_name || '\\n"Annex, ' || source_row || '"' ELSE facility_name END""")
    t.raw_facilities(spark, d).drop("balance").withColumn("facility_name", annex).write.options(**lake.CSV).csv(path)
    return columns.trim_column_names(readers.read_registry(spark, path, multi_line=True))


def lake_tables(spark, d):
    """Country partitions, one of them replaced, then a monthly snapshot and the table over it."""
    root = shared_folder(spark)
    fac = flagged(spark, d).select("source_row", "facility_name", "data_quality_flag", "country")
    lake.write_country_tables(fac, f"{root}/countries")
    kenya = fac.filter("country = 'Kenya'").withColumn("data_quality_flag", F.lit("unknown"))
    lake.write_country_tables(kenya, f"{root}/countries")
    merged = merging.stamp(readers.read_standardized(spark, f"{root}/countries"), RUN_DATE)
    month = lake.write_snapshot(merged, f"{root}/snapshots", RUN_DATE)
    lake.point_table(spark, "health_facilities", month)
    return spark.table("health_facilities")


def services_table(spark, d):
    """Services written as the published table, partitioned by country, and read back."""
    lake.replace_table(services_plan(spark, d), "facility_services", f"{shared_folder(spark)}/services", partition_by="country_iso")
    return spark.table("facility_services")


def run_report(spark, d):
    """Reports of a table written and one of them read back."""
    fac = written(typing.enforce_schema(flagged(spark, d).drop("ownership_raw"), FACILITY_FIELDS))
    folder = shared_folder(spark)
    reports.write_reports(reports.facility_reports(fac), folder)
    return spark.read.parquet(f"{folder}/quality")


def counted_lake(spark, d):
    """Facilities by country with their counters, of which one country is replaced by changed rows; where they are."""
    root = shared_folder(spark)
    fac = flagged(spark, d).select("source_row", "facility_name", "facility_code", "admin1", "latitude", "data_quality_flag", "country")
    schema = fac.schema
    lake.write_country_tables(fac, f"{root}/countries")
    counters = partials.partial_counters(
        spark.read.schema(schema).parquet(f"{root}/countries"), ["country", "data_quality_flag"], distinct=["facility_name", "admin1"])
    lake.write_country_tables(counters, f"{root}/counters")
    changed = fac.filter("country = 'Kenya'").withColumn("data_quality_flag", F.lit("unknown")).withColumn("latitude", F.expr("nullif(latitude, latitude)"))
    lake.write_country_tables(changed, f"{root}/countries")
    facility_plan.write_counters(spark.read.schema(schema).parquet(f"{root}/countries"), f"{root}/counters", "Kenya")
    return root


def stored_quality(spark, d):
    """Quality by country from the stored counters alone."""
    return reports.stored_reports(spark, f"{counted_lake(spark, d)}/counters")["quality"]


def stored_completeness(spark, d):
    return reports.stored_reports(spark, f"{counted_lake(spark, d)}/counters")["completeness"].filter("column_name <> 'source_row'")


def distinct_sketches(spark, d):
    """Distinct names and districts per country: exact, and whether merged sketches are within 5 % of that."""
    fac = flagged(spark, d).select("source_row", "facility_name", "admin1", "country")
    by_part = partials.partial_counters(fac.withColumn("part", F.col("source_row") % 7), ["country", "part"], distinct=["facility_name", "admin1"])
    guessed = partials.distinct_from(written(by_part), "country")
    exact = fac.groupBy("country").agg(F.count_distinct("facility_name").alias("facility_name"), F.count_distinct("admin1").alias("admin1"))
    exact = exact.unpivot("country", ["facility_name", "admin1"], "column_name", "n_exact")
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 0.05 * F.col("n_exact")
    return exact.join(guessed, ["country", "column_name"]).select("country", "column_name", "n_exact", near.alias("within"))


def uid_registry(spark, d):
    """Registry on disk: known codes appended first, then the new ones, then read as written."""
    path = shared_folder(spark)
    lake.append_rows(t.registry(spark, d), path)
    return facility_plan.register_new(spark, t.raw_facilities(spark, d), path, RUN_DATE, country="iso")


def registry_versions(spark, d):
    """Registry after each of three runs on a third of the facilities: rows and identifiers of every version."""
    path = shared_folder(spark)
    lake.append_rows(t.registry(spark, d), path)
    raw = t.raw_facilities(spark, d)
    for k in range(3):
        facility_plan.register_new(spark, raw.filter(F.col("source_row") % 3 == k), path, RUN_DATE, country="iso")
    versions = [readers.read_uid_registry(spark, path, v).withColumn("version", F.lit(v)) for v in range(4)]
    rows = reduce(lambda a, b: a.unionByName(b), versions)
    return rows.groupBy("version", "country").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("uid").alias("n_uids"))


def geocode_landed(spark, d):
    """Pending queries written, answered, landed twice in the cache, and the rows filled from it."""
    path = shared_folder(spark)
    lake.append_rows(t.geocode_cache(spark, d), path)
    rows = coordinates.coerce_coordinates(t.raw_facilities(spark, d))
    pending = written(coordinates.geocode_pending(coordinates.fill_from_cache(rows, readers.read_geocode_cache(spark, path))))
    answers = pending.select(
        F.col("geocode_query").alias("query"), (F.length("geocode_query") + 0.5).alias("result_lat"),
        F.lit(0.25).cast("double").alias("result_lon"), F.lit("place").alias("result_type"),
    )
    for _ in range(2):
        facility_plan.land_answers(spark, answers, path)
    out = coordinates.fill_from_cache(rows, readers.read_geocode_cache(spark, path))
    return out.select("source_row", "geocode_query", "geocode_status", "latitude", "longitude", "coordinate_source")


def run_feeds(spark, d):
    """One feed that is there and one that is not, into the published table; where the run keeps its datasets."""
    folder = shared_folder(spark)
    paths = facility_plan.LakePaths(f"{folder}/lake")
    lake.append_rows(t.registry(spark, d), paths.registry)
    services = t.raw_services(spark, d)
    with more_partitions(spark, lookups.partitions_of(t.read(spark, d, "lineitem"), 1024)):  # the join with the parts, too, by the size of the list
        services.write.parquet(f"{folder}/list.parquet")
    t.crosswalk(spark, d).write.options(**lake.CSV).csv(f"{folder}/crosswalk.csv")
    inputs = {iso: (f"{folder}/{name}.parquet", f"{folder}/crosswalk.csv") for iso, name in (("TZA", "list"), ("KEN", "missing"))}
    service_plan.run_services(spark, inputs, paths, feeds={"TZA": FEED, "KEN": FEED}, table="services_of_run", order_by=t.SERVICE_ORDER)
    return paths


def services_run(spark, d):
    """Services published by a run in which a feed failed."""
    run_feeds(spark, d)
    return spark.table("services_of_run").withColumn("source_url", F.lit("services.csv"))


def services_log(spark, d):
    """What that run wrote into its log, with the rows of each feed."""
    log = spark.read.parquet(run_feeds(spark, d).log)
    rows = F.regexp_extract("message", r"^rows: (\d+)$", 1)
    return log.select("country", "step", "status", rows.try_cast("bigint").alias("n_rows"))


def services_counters(spark, d):
    """Counters of the feeds of that run."""
    log = spark.read.parquet(runlog.counters_path(run_feeds(spark, d).log))
    return log.select("country", "step", "counter", "n")


QUERIES = {
    f.__name__: f
    for f in (
        lake_summary, standardize_columns, ownership_class, coord_clean, coord_clean_keep, date_clean,
        date_clean_strict, iso_datetime, enforce_schema, schema_rejects, quality_flag, quality_distribution,
        within_filter, within_flag, geocode_cache, geocode_failures, coord_lookup, union_merge, completeness,
        completeness_by_country, step_counters, contract_facilities, country_counts, geocode_pending, located_list,
        uid_highest, uid_new, uid_reuse_mint, service_uid, facility_uid_join, facility_uid_join_skewed, orphan_codes,
        crosswalk_two_key, crosswalk_two_key_skewed, crosswalk_one_key, crosswalk_unmatched, unmatched_report,
        crosswalk_gap, rule_exact, rule_first_match, rule_names, vocab_inventory, vocab_union, crosswalk_qa,
        service_report, domain_distribution, domain_counts, malaria_counts, source_profile, category_counts,
        table_rows, contract_services, facility_service_join, facility_service_top,
        split_explode, split_lists, json_props, payload_facilities, payload_services,
        facilities_plan, services_plan, services_slim, csv_registry, lake_tables, uid_registry,
        uid_reuse_mint_any_code, services_plan_large, within_flag_large, facility_service_hot, services_table, run_report,
        rule_table, crosswalk_built, payload_prepared, wide_prepared,
        registry_versions, geocode_landed, services_run, services_log, within_flag_geojson, polygon_edges, ring_problems,
        within_flag_sphere, within_sphere_world, rules_indexed, facility_uid_join_bucketed, stored_quality,
        stored_completeness, distinct_sketches, services_counters,
    )
}
