"""The registered queries as SQL for the other engine."""

from __future__ import annotations

from checks import tables as t
from checks.tables import sql
from registry_spark.schema import FACILITY_FIELDS, SERVICE_FIELDS
from registry_spark.vocabularies import CATEGORY_DEFAULTS, CATEGORY_RULES, MALARIA_DETAIL, NAME_RULES, SUPPORT

DEEP = "' ' || chr(9) || chr(10) || chr(13)"
YEAR = "CASE WHEN year(open_date) BETWEEN 1900 AND 2026 THEN CAST(year(open_date) AS INTEGER) END"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def percent(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) * 100.0 / CAST({whole} AS DOUBLE)"


def count_if(test: str) -> str:
    return f"count(CASE WHEN {test} THEN 1 END)"


def unicode_boundaries(pattern: str) -> str:
    """Word boundaries spelled out, since the other engine's only know ASCII letters."""
    other = r"[^\p{L}\p{M}\p{Nd}_]"
    spelled = []
    for alternative in pattern.split("|"):
        if alternative.startswith(r"\b"):
            alternative = f"(?:^|{other})" + alternative[2:]
        if alternative.endswith(r"\b"):
            alternative = alternative[:-2] + f"(?:{other}|$)"
        spelled.append(alternative)
    return "|".join(spelled)


def name_rule_case(category: str, name: str, value) -> str:
    whens = " ".join(
        f"WHEN regexp_matches(lower({name}), {quote('(?i)' + unicode_boundaries(r.pattern))}) THEN {value(r, True)}" for r in NAME_RULES
    )
    otherwise = " ".join(f"WHEN {quote(r.category)} THEN {value(r, False)}" for r in CATEGORY_DEFAULTS)
    return f"CASE {whens} ELSE CASE {category} {otherwise} END END"


def name_rule_columns(category: str, name: str) -> str:
    def flag(attribute):
        def value(rule, by_name):
            return str(rule.domain != SUPPORT if by_name else getattr(rule, attribute)).upper()
        return value

    return f"""{name_rule_case(category, name, lambda r, _: quote(r.domain))} AS service_domain,
 {name_rule_case(category, name, lambda r, _: quote(r.group))} AS service_group,
 {name_rule_case(category, name, flag('is_clinical'))} AS is_clinical,
 {name_rule_case(category, name, flag('include_in_analysis'))} AS include_in_analysis"""


EXACT_RULES = "(VALUES " + ", ".join(
    f"({quote(r.category)}, {quote(r.domain)}, {quote(r.group)}, {r.is_clinical}, FALSE, {r.include_in_analysis})"
    for r in CATEGORY_RULES
) + ") AS r(category, domain, grp, clinical, malaria, include)"


def completeness() -> str:
    names = ["source_row", "balance", "facility_code", "facility_name", "country", "iso", "admin1", "admin2", "facility_type",
             "ownership_raw", "latitude", "longitude", "open_date_raw", "status", "catchment_population", "inpatient"]
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS non_null, count(*) AS n_rows,
 round_even(100.0::DOUBLE - round_even({percent(f'count(*) - count({c})', 'count(*)')}, 1), 1) AS pct_non_null FROM fac"""
        for c in names
    )


def contract(table: str, fields, present: set[str]) -> str:
    parts = []

    def row(name: str, rule: str, value: str, source: str = table) -> None:
        parts.append(
            f"SELECT {quote(name)} AS column_name, {quote(rule)} AS rule, CAST({value} AS BIGINT) AS violations FROM {source}"
        )

    for f in fields:
        if f.name not in present:
            continue
        if f.required:
            row(f.name, "required", count_if(f"{f.name} IS NULL"))
        if f.allowed:
            row(f.name, "allowed", count_if(f"{f.name} NOT IN ({', '.join(map(quote, f.allowed))})"))
        if f.low is not None:
            row(f.name, "range", count_if(f"{f.name} NOT BETWEEN {f.low} AND {f.high}"))
        if f.unique:
            key = f.name if f.within not in present else f"CASE WHEN {f.name} IS NOT NULL THEN ({f.within}, {f.name}) END"
            row(f.name, "unique", f"count({f.name}) - count(DISTINCT {key})")
    return " UNION ALL ".join(parts)


SIDE = "((v.latitude - y1) * (x2 - x1) - (v.longitude - x1) * (y2 - y1))"
INSIDE = f"""SELECT v.*, v.country IN (SELECT country FROM edges) AS covered,
 (SELECT count(*) FROM edges e WHERE e.country = v.country AND (y1 <= v.latitude) <> (y2 <= v.latitude)
 AND {SIDE} <> 0 AND ({SIDE} > 0) = (y2 > y1)) % 2 = 1 AS odd,
 EXISTS (SELECT 1 FROM edges e WHERE e.country = v.country AND {SIDE} = 0
 AND v.latitude BETWEEN least(y1, y2) AND greatest(y1, y2)
 AND v.longitude BETWEEN least(x1, x2) AND greatest(x1, x2)) AS touching FROM valid v"""

# Numbering: hash of the order columns and the chunk of copies, then the order columns.
NUMBERED = """SELECT *, row_number() OVER (ORDER BY md5(l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|'
 || l_linenumber || '|' || chunk), l_orderkey, l_partkey, l_suppkey, l_linenumber, chunk) AS number
 FROM (SELECT *, (row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber) - 1) // 10000 AS chunk
 FROM svc)"""

TOP = "SELECT country, max(CAST(regexp_extract(uid, '(\\d+)$', 1) AS BIGINT)) AS highest FROM reg GROUP BY country"

MINTED = f"""SELECT n.country, n.facility_code,
 printf('%s-%06d', n.country, coalesce(highest, 0) + row_number() OVER (PARTITION BY n.country
 ORDER BY md5(n.facility_code || '|0'), n.facility_code)) AS uid, DATE '2026-01-31' AS created_date
 FROM (SELECT DISTINCT iso AS country, facility_code FROM fac WHERE facility_code <> '') n
 LEFT JOIN ({TOP}) top ON top.country = n.country
 WHERE NOT EXISTS (SELECT 1 FROM reg r WHERE r.country = n.country AND r.facility_code = n.facility_code)"""

SQUISH = "trim(regexp_replace({}, '[\\s\\p{{Z}}]+', ' ', 'g'))"

GEOCODED = f"""SELECT f.*, q.result_lat, q.result_lon, q.query IS NOT NULL AS known, CASE WHEN f.latitude IS NULL OR f.longitude IS NULL
 THEN concat_ws(', ', trim(facility_name, {DEEP}), trim(admin1, {DEEP}), trim(country, {DEEP})) END AS geocode_query
 FROM coord f LEFT JOIN (SELECT query, first(result_lat ORDER BY result_lat NULLS LAST, result_lon) AS result_lat,
 first(result_lon ORDER BY result_lat NULLS LAST, result_lon) AS result_lon FROM cache GROUP BY query) q
 ON (f.latitude IS NULL OR f.longitude IS NULL) AND q.query = concat_ws(', ', trim(facility_name, {DEEP}),
 trim(admin1, {DEEP}), trim(country, {DEEP}))"""

SERVICE_COLUMNS = "service_domain, service_group, service_name"
FLAG_COLUMNS = "is_clinical, is_malaria_related, include_in_analysis, needs_review"
ORDER = "l_orderkey, l_partkey, l_suppkey, l_linenumber"

SERVICES = f"""SELECT printf('%s-%06d', 'TZA-SVC', number) AS uid,
 CASE WHEN r.country = 'TZA' THEN r.uid END AS facility_uid, 'TZA' AS country_iso, 'Tanzania' AS country_name,
 {SERVICE_COLUMNS}, CAST(l_partkey AS VARCHAR) AS source_service_id, CAST(NULL AS VARCHAR) AS source_type_id,
 service_category AS source_category_id, s.service_detail AS source_service_name, {FLAG_COLUMNS},
 CAST(NULL AS DATE) AS extracted_date, 'services.csv' AS source_url, '2.0' AS pipeline_version, s.facility_code
 FROM ({NUMBERED}) s LEFT JOIN cw c ON s.service_category IS NOT DISTINCT FROM c.source_category
 AND trim(s.service_detail, {DEEP}) IS NOT DISTINCT FROM c.source_detail
 LEFT JOIN reg1 r ON r.country = 'TZA' AND r.facility_code = s.facility_code"""

LOCATED = """SELECT r.uid, f.facility_name, f.latitude, f.longitude, f.country FROM coord f
 JOIN reg1 r ON r.country = f.iso AND r.facility_code = f.facility_code"""

PAIRED = f"""SELECT l.facility_name, l.latitude, l.longitude, l.country, j.service_name, j.service_domain
 FROM ({LOCATED}) l JOIN joined j ON j.facility_uid = l.uid WHERE j.is_malaria_related AND j.include_in_analysis"""

PAYLOAD = """SELECT conv_id, turn, role, text, CASE WHEN turn % 3 = 1 THEN 'N' || conv_id || '-' || turn
 ELSE 'c' || conv_id || '-' || turn END AS code FROM conversations"""

# A name with a line break and quotes on every fifth facility.
WRITTEN_NAME = """CASE WHEN source_row % 5 = 0 THEN facility_name || chr(10) || '"Annex, ' || source_row || '"' ELSE facility_name END"""

# Two-letter codes in lower case and upper case, as some registries use.
ANY_CODE = """(SELECT * REPLACE (CASE WHEN {c} < 'M' THEN lower(substr({c}, 1, 2)) ELSE substr({c}, 1, 2) END AS {c}) FROM {t})"""
ANY_REG = ANY_CODE.format(c="country", t="reg")
ANY_MINTED = f"""SELECT n.country, n.facility_code, printf('%s-%06d', n.country, coalesce(highest, 0) + row_number() OVER (
 PARTITION BY n.country ORDER BY md5(n.facility_code || '|0'), n.facility_code)) AS uid
 FROM (SELECT DISTINCT iso AS country, facility_code FROM {ANY_CODE.format(c="iso", t="fac")} WHERE facility_code <> '') n
 LEFT JOIN (SELECT country, max(CAST(regexp_extract(uid, '(\\d+)$', 1) AS BIGINT)) AS highest FROM {ANY_REG} GROUP BY country) top
 ON top.country = n.country
 WHERE NOT EXISTS (SELECT 1 FROM {ANY_REG} r WHERE r.country = n.country AND r.facility_code = n.facility_code)"""

# One facility holds a third of the services.
HOT = """SELECT f.facility_name, f.latitude, f.longitude, f.country, s.service_detail AS service_name,
 s.service_category AS service_domain FROM coord f
 JOIN (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN '7' ELSE facility_code END AS code FROM svc) s
 ON s.code = f.facility_code WHERE f.facility_code <> ''"""

POLYGONS = """SELECT CAST(c_custkey AS VARCHAR) AS country, CAST(x0 + a AS DOUBLE) AS x1, CAST(y0 + b AS DOUBLE) AS y1,
 CAST(x0 + c AS DOUBLE) AS x2, CAST(y0 + d AS DOUBLE) AS y2
 FROM (SELECT c_custkey, c_custkey * 37 % 300 - 150 AS x0, c_custkey * 53 % 120 - 60 AS y0 FROM customer),
 (VALUES (0, 0, 4, 0, FALSE), (4, 0, 4, 4, FALSE), (4, 4, 0, 4, FALSE), (0, 4, 0, 0, FALSE),
 (1, 1, 1, 3, FALSE), (1, 3, 3, 3, FALSE), (3, 3, 3, 1, FALSE), (3, 1, 1, 1, FALSE),
 (6, 0, 8, 0, TRUE), (8, 0, 7, 3, TRUE), (7, 3, 6, 0, TRUE)) AS e(a, b, c, d, island)
 WHERE NOT island OR c_custkey % 5 = 0"""

RING_PROBLEMS = """SELECT CAST(c_custkey AS VARCHAR) AS country, 0 AS part, 0 AS ring,
 CASE c_custkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 5 ELSE 4 END AS n_points,
 CAST(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_crossings,
 CASE c_custkey % 4 WHEN 0 THEN 'crossing' WHEN 1 THEN 'open' WHEN 3 THEN 'no_number' END AS problem FROM customer"""

ORACLES = {
    "polygon_edges": POLYGONS,
    "ring_problems": RING_PROBLEMS,
    "within_flag_geojson": sql(
        f"""SELECT source_row, country, CASE WHEN latitude IS NULL OR longitude IS NULL THEN NULL
 WHEN NOT covered THEN coordinate_valid ELSE coordinate_valid AND odd AND NOT touching END AS coordinate_valid
 FROM ({INSIDE})""", "valid", "edges"),
    "uid_reuse_mint_any_code": sql(
        f"""SELECT f.source_row, f.iso, f.facility_code, coalesce(r.uid, m.uid) AS uid FROM {ANY_CODE.format(c="iso", t="fac")} f
 LEFT JOIN (SELECT country, facility_code, min_by(uid, (length(uid), uid)) AS uid FROM {ANY_REG} GROUP BY 1, 2) r
 ON r.country = f.iso AND r.facility_code = f.facility_code
 LEFT JOIN ({ANY_MINTED}) m ON m.country = f.iso AND m.facility_code = f.facility_code""", "reg"),
    "facility_service_hot": sql(HOT, "coord", "svc"),
    "services_plan_large": sql(SERVICES, "svc", "cw", "reg1"),
    "services_table": sql(f"SELECT * FROM ({SERVICES})", "svc", "cw", "reg1"),
    "within_flag_large": sql(
        f"""SELECT source_row, country, CASE WHEN latitude IS NULL OR longitude IS NULL THEN NULL
 WHEN NOT covered THEN coordinate_valid ELSE coordinate_valid AND odd AND NOT touching END AS coordinate_valid
 FROM ({INSIDE})""", "valid", "edges"),
    "run_report": sql(
        f"""SELECT country, data_quality_flag, n_facilities, pct_of_country FROM (SELECT country,
 coalesce(data_quality_flag, '(null)') AS data_quality_flag, count(*) AS n_facilities,
 round({percent('count(*)', 'sum(count(*)) OVER (PARTITION BY country)')}, 1) AS pct_of_country
 FROM quality GROUP BY country, data_quality_flag)""", "quality"),
    "lake_summary": sql(
        f"""SELECT country, coalesce(data_quality_flag, '(null)') AS data_quality_flag, count(*) AS n_facilities,
 round({percent('count(*)', 'sum(count(*)) OVER (PARTITION BY country)')}, 1) AS pct_of_country
 FROM quality GROUP BY country, data_quality_flag""", "quality"),
    "standardize_columns": """SELECT c_custkey AS facility_code, c_name AS facility_name, c_nationkey AS admin1,
 c_mktsegment AS facility_type, c_acctbal AS latitude, c_mktsegment AS ownership_detail,
 CAST(NULL AS VARCHAR) AS ownership, 'Kenya' AS country, 'Customer table' AS data_source FROM customer""",
    "ownership_class": sql("SELECT source_row, ownership_raw, ownership FROM coord", "coord"),
    "coord_clean": sql("""SELECT source_row, country, latitude, longitude, coordinate_valid FROM valid
 WHERE latitude IS NOT NULL AND longitude IS NOT NULL""", "valid"),
    "coord_clean_keep": sql(
        "SELECT source_row, country, latitude, longitude, coordinate_valid FROM valid", "valid"),
    "date_clean": sql(f"SELECT source_row, open_date, {YEAR} AS open_year FROM dated", "dated"),
    "date_clean_strict": sql(
        f"""SELECT source_row, CASE WHEN {YEAR} IS NOT NULL THEN open_date END AS open_date,
 {YEAR} AS open_year FROM dated""", "dated"),
    "iso_datetime": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS extracted_date FROM orders",
    "enforce_schema": sql(
        f"""SELECT source_row, facility_code, {t.number('latitude')} AS latitude,
 TRY_CAST(trunc({t.number('catchment_population')}) AS INTEGER) AS catchment_population,
 coalesce(upper(inpatient) IN ('TRUE', 'YES', '1', 'Y'), FALSE) AS inpatient, CAST(NULL AS BOOLEAN) AS outpatient,
 CAST(try_strptime(open_date_raw, '%Y-%m-%d') AS DATE) AS open_date, CAST(NULL AS VARCHAR) AS zone FROM fac""", "fac"),
    "schema_rejects": sql(
        f"""SELECT 'latitude' AS column_name, {count_if(f"latitude <> '' AND ({t.number('latitude')}) IS NULL")} AS rejected
 FROM fac UNION ALL SELECT 'catchment_population', {count_if(f"catchment_population <> '' AND TRY_CAST(trunc({t.number('catchment_population')}) AS INTEGER) IS NULL")}
 FROM fac UNION ALL SELECT 'open_date',
 {count_if("open_date_raw <> '' AND try_strptime(open_date_raw, '%Y-%m-%d') IS NULL")} FROM fac""", "fac"),
    "quality_flag": sql("SELECT source_row, coordinate_valid, data_quality_flag FROM quality", "quality"),
    "quality_distribution": sql(
        f"""SELECT data_quality_flag, count(*) AS n,
 round_even({percent('count(*)', 'sum(count(*)) OVER ()')}, 1) AS pct FROM quality GROUP BY 1""", "quality"),
    "within_filter": sql(
        f"""SELECT source_row, country, latitude, longitude, coordinate_valid FROM ({INSIDE})
 WHERE latitude IS NOT NULL AND longitude IS NOT NULL
 AND (NOT covered OR (coordinate_valid AND (odd OR touching)))""", "valid", "edges"),
    "within_flag": sql(
        f"""SELECT source_row, country, CASE WHEN latitude IS NULL OR longitude IS NULL THEN NULL
 WHEN NOT covered THEN coordinate_valid ELSE coordinate_valid AND odd AND NOT touching END AS coordinate_valid
 FROM ({INSIDE})""", "valid", "edges"),
    "geocode_cache": sql(
        f"""SELECT source_row, geocode_query, CASE WHEN geocode_query IS NULL THEN NULL WHEN NOT known THEN 'pending'
 WHEN result_lat IS NULL THEN 'failed' ELSE 'cached' END AS geocode_status,
 CASE WHEN result_lat IS NOT NULL THEN result_lat ELSE latitude END AS latitude,
 CASE WHEN result_lat IS NOT NULL THEN result_lon ELSE longitude END AS longitude,
 CASE WHEN result_lat IS NOT NULL THEN 'OSM' END AS coordinate_source FROM ({GEOCODED})""", "coord", "cache"),
    "geocode_failures": sql(
        f"SELECT source_row, geocode_query FROM ({GEOCODED}) WHERE known AND result_lat IS NULL", "coord", "cache"),
    "geocode_pending": sql(
        f"SELECT DISTINCT geocode_query FROM ({GEOCODED}) WHERE geocode_query IS NOT NULL AND NOT known", "coord", "cache"),
    "located_list": sql(
        """SELECT CAST(o.o_custkey AS VARCHAR) AS facility_code, 'F' || o.o_custkey AS facility_name,
 o.o_orderpriority AS facility_type, o.o_orderstatus AS facility_ownership, 'R' AS admin1, 'Z' AS admin2,
 o.o_orderkey AS admin3, k.latitude, k.longitude, 'Open' AS status
 FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
 ORDER BY o_orderkey, o_orderpriority, o_orderstatus) = 1) o
 LEFT JOIN (SELECT source_row, first(latitude ORDER BY latitude NULLS FIRST, longitude NULLS FIRST) AS latitude,
 first(longitude ORDER BY latitude NULLS FIRST, longitude NULLS FIRST) AS longitude FROM coord GROUP BY source_row) k ON k.source_row = o.o_custkey""", "coord"),
    "completeness_by_country": sql(
        " UNION ALL ".join(
            f"""SELECT country, '{c}' AS column_name, count({c}) AS non_null, count(*) AS n_rows,
 round_even(100.0::DOUBLE - round_even({percent(f'count(*) - count({c})', 'count(*)')}, 1), 1) AS pct_non_null
 FROM fac GROUP BY country""" for c in ("facility_name", "latitude")), "fac"),
    "coord_lookup": sql(
        f"""SELECT CAST(o.o_custkey AS VARCHAR) AS facility_code, o.o_orderkey, o.o_orderstatus, k.latitude, k.longitude
 FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey, o_orderstatus) = 1) o
 LEFT JOIN coord k ON k.source_row = o.o_custkey""", "coord"),
    "union_merge": sql(
        f"""SELECT source_row, facility_code, facility_name, 'Nigeria' AS country,
 CAST(NULL AS INTEGER) AS catchment_population, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS BOOLEAN) AS inpatient,
 CAST(NULL AS VARCHAR) AS ward, DATE '2026-01-31' AS extraction_date FROM fac WHERE balance < 4000
 UNION ALL BY NAME SELECT source_row, facility_code, country,
 TRY_CAST(trunc({t.number('catchment_population')}) AS INTEGER) AS catchment_population, admin2 AS ward,
 DATE '2026-01-31' AS extraction_date FROM fac WHERE balance >= 4000""", "fac"),
    "completeness": sql(completeness(), "fac"),
    "step_counters": sql(
        f"""SELECT count(*) AS rows, {count_if('latitude IS NULL OR longitude IS NULL')} AS missing,
 {count_if('coordinate_valid')} AS valid, {count_if('NOT coordinate_valid')} AS invalid,
 count(open_date) AS dated, {count_if('open_date IS NULL')} AS undated, count(facility_code) AS assigned,
 {count_if('facility_code IS NULL')} AS skipped
 FROM (SELECT *, {t.OPEN_DATE} AS open_date FROM valid)""", "valid"),
    "contract_facilities": sql(
        contract("typed", FACILITY_FIELDS, {f.name for f in FACILITY_FIELDS}).replace(
            "FROM typed", """FROM (SELECT *, CAST(NULL AS VARCHAR) AS uid, CAST(NULL AS VARCHAR) AS data_source
 FROM quality) AS typed"""), "quality"),
    "country_counts": sql("SELECT country, count(*) AS facilities FROM fac GROUP BY country", "fac"),
    "uid_highest": sql(TOP, "reg"),
    "uid_new": sql(MINTED, "reg"),
    "uid_reuse_mint": sql(
        f"""SELECT f.source_row, f.iso, f.facility_code, coalesce(r.uid, m.uid) AS uid FROM fac f
 LEFT JOIN reg1 r ON r.country = f.iso AND r.facility_code = f.facility_code
 LEFT JOIN ({MINTED}) m ON m.country = f.iso AND m.facility_code = f.facility_code""", "reg1"),
    "service_uid": sql(
        f"SELECT {ORDER}, facility_code, printf('%s-%06d', 'TZA-SVC', number) AS uid FROM ({NUMBERED})", "svc"),
    "facility_uid_join": sql(
        f"SELECT {ORDER}, facility_code, country_iso, facility_uid FROM joined", "joined"),
    "facility_uid_join_skewed": sql(
        f"SELECT {ORDER}, facility_code, country_iso, facility_uid FROM joined", "joined"),
    "orphan_codes": sql(
        """SELECT country_iso, facility_code, count(*) AS n FROM joined
 WHERE facility_uid IS NULL AND facility_code IS NOT NULL GROUP BY 1, 2""", "joined"),
    "crosswalk_two_key": sql(f"SELECT {ORDER}, {SERVICE_COLUMNS}, {FLAG_COLUMNS} FROM joined", "joined"),
    "crosswalk_two_key_skewed": sql(f"SELECT {ORDER}, {SERVICE_COLUMNS}, {FLAG_COLUMNS} FROM joined", "joined"),
    "crosswalk_one_key": sql(
        f"""SELECT {ORDER}, c.service_domain, c.service_group,
 coalesce(c.service_name, trim(s.service_detail, ' ')) AS service_name FROM svc s
 LEFT JOIN (SELECT * FROM cw QUALIFY row_number() OVER (PARTITION BY source_detail ORDER BY service_domain NULLS FIRST,
 service_group NULLS FIRST, service_name NULLS FIRST, is_clinical NULLS FIRST, is_malaria_related NULLS FIRST,
 include_in_analysis NULLS FIRST, needs_review NULLS FIRST) = 1) c
 ON trim(s.service_detail, {DEEP}) IS NOT DISTINCT FROM c.source_detail""", "svc", "cw"),
    "crosswalk_unmatched": sql(
        "SELECT DISTINCT facility_code, source_service_name FROM joined WHERE service_domain IS NULL", "joined"),
    "unmatched_report": sql(
        """SELECT facility_code, source_service_name, greatest(total - 50, 0) AS n_more
 FROM (SELECT *, count(*) OVER () AS total FROM (SELECT DISTINCT facility_code, source_service_name FROM joined
 WHERE service_domain IS NULL)) ORDER BY facility_code NULLS FIRST, source_service_name NULLS FIRST LIMIT 50""",
        "joined"),
    "crosswalk_gap": sql(
        f"""SELECT DISTINCT service_category, trim(service_detail, {DEEP}) AS service_detail FROM svc s
 WHERE NOT EXISTS (SELECT 1 FROM cw WHERE source_category IS NOT DISTINCT FROM s.service_category
 AND source_detail IS NOT DISTINCT FROM trim(s.service_detail, {DEEP}))""", "svc", "cw"),
    "rule_exact": f"""SELECT category0 AS source_category, detail AS source_service_name,
 CASE WHEN hit THEN 'Malaria Services' ELSE r.domain END AS service_domain,
 CASE WHEN hit THEN 'Malaria Diagnosis and Treatment' ELSE r.grp END AS service_group, detail AS service_name,
 r.clinical AS is_clinical, (r.malaria OR hit) AS is_malaria_related, r.include AS include_in_analysis,
 r.domain IS NULL AS needs_review FROM (SELECT DISTINCT category0, detail,
 regexp_matches(lower(detail), {quote(MALARIA_DETAIL)}) AS hit FROM (SELECT CASE p_type
 WHEN 'STANDARD' THEN 'HIV TREATMENT' WHEN 'ECONOMY' THEN 'MORTUARY SERVICES' WHEN 'SMALL' THEN 'ANTENATAL CARE'
 WHEN 'LARGE' THEN 'THEATRE SERVICES' WHEN 'PROMO' THEN 'UNKNOWN SERVICES' END AS category0,
 CASE WHEN p_name LIKE '% gizmo' THEN 'mRDT ' || p_name ELSE p_name END AS detail FROM part)
 WHERE category0 IS NOT NULL AND detail IS NOT NULL) LEFT JOIN {EXACT_RULES} ON r.category = category0""",
    "rule_first_match": f"""SELECT doc_id, {name_rule_columns('category', 'text')} FROM (SELECT doc_id, text,
 CASE doc_id % 5 WHEN 0 THEN 'clinical_services' WHEN 1 THEN 'support_services' WHEN 2 THEN 'diagnostic_services'
 WHEN 3 THEN 'twenty_four_hour' ELSE 'other' END AS category FROM documents)""",
    "rule_names": f"""SELECT category AS source_category, name AS source_service_name, name AS service_name,
 {name_rule_columns('category', 'name')}, regexp_matches(name, '(?i)malaria|mrdt') AS is_malaria_related,
 regexp_matches(name, '(?i)^error|^others$') AS needs_review FROM (SELECT DISTINCT
 CASE WHEN p_size % 2 = 0 THEN 'clinical_services' ELSE 'support_services' END AS category,
 CASE p_size % 6 WHEN 0 THEN p_name || ' Surgery' WHEN 1 THEN 'ANC ' || p_name WHEN 2 THEN p_name || ' management'
 WHEN 3 THEN 'Malaria ' || p_name WHEN 4 THEN 'Error ' || p_name ELSE p_name END AS name FROM part)""",
    "vocab_inventory": sql(
        """SELECT DISTINCT service_category, service_detail FROM svc
 WHERE service_category IS NOT NULL AND service_detail IS NOT NULL""", "svc"),
    "vocab_union": sql(
        """SELECT *, CAST(NULL AS VARCHAR) AS source_group, 'TZA' AS country_iso FROM cw
 UNION ALL BY NAME SELECT * EXCLUDE (needs_review), service_group AS source_group, 'KEN' AS country_iso FROM cw""",
        "cw"),
    "crosswalk_qa": sql(
        """SELECT 'domain' AS measure, coalesce(service_domain, '(null)') AS value, count(*) AS n FROM cw GROUP BY 2
 UNION ALL SELECT 'include_in_analysis', coalesce(CAST(include_in_analysis AS VARCHAR), '(null)'), count(*) FROM cw GROUP BY 2
 UNION ALL SELECT 'needs_review', 'true', count(*) FROM cw WHERE needs_review HAVING count(*) > 0
 UNION ALL SELECT 'without_rule', coalesce(source_category, '(null)'), count(*) FROM cw WHERE service_domain IS NULL GROUP BY 2
 UNION ALL SELECT 'conflicting_keys', 'all', count(*) FROM (SELECT source_detail FROM (SELECT DISTINCT * FROM cw)
 GROUP BY source_detail HAVING count(*) > 1)""",
        "cw"),
    "service_report": sql(
        f"""SELECT count(*) AS total_records, count(DISTINCT coalesce(facility_code, '(none)')) AS unique_facilities,
 count(facility_uid) AS matched_uid, count(*) - count(facility_uid) AS unmatched_uid,
 {count_if('include_in_analysis')} AS included, {count_if('needs_review')} AS to_review,
 round_even({percent('count(facility_uid)', 'count(*)')}, 1) AS pct_matched FROM joined""", "joined"),
    "domain_distribution": sql(
        f"""SELECT service_domain, n, pct FROM (SELECT service_domain, count(*) AS n,
 round_even({percent('count(*)', 'sum(count(*)) OVER ()')}, 1) AS pct FROM joined GROUP BY 1)
 WHERE service_domain IS NOT NULL""", "joined"),
    "domain_counts": sql(
        "SELECT service_domain, count(*) AS n FROM joined WHERE include_in_analysis GROUP BY 1", "joined"),
    "malaria_counts": sql(
        """SELECT country_iso AS country_name, service_group, service_name, count(*) AS facilities FROM joined
 WHERE is_malaria_related AND include_in_analysis GROUP BY 1, 2, 3""", "joined"),
    "source_profile": sql(
        f"""SELECT count(DISTINCT facility_code) AS n_ids, count(*) AS n_rows, count(DISTINCT service_detail) AS n_names,
 count(DISTINCT service_category) AS n_categories, round_even({percent('count(service_detail)', 'count(*)')}, 1) AS pct_located
 FROM svc""", "svc"),
    "category_counts": sql("SELECT service_category, count(*) AS n FROM svc GROUP BY 1", "svc"),
    "table_rows": sql("SELECT count(*) AS n FROM svc", "svc"),
    "contract_services": sql(
        contract("typed", SERVICE_FIELDS, {
            "uid", "facility_uid", "country_iso", "service_domain", "service_group", "service_name",
            "source_service_name", "is_clinical", "is_malaria_related", "include_in_analysis", "facility_code",
            "needs_review",
        }).replace("FROM typed", "FROM (SELECT *, CAST(l_orderkey AS VARCHAR) AS uid FROM joined) AS typed"), "joined"),
    "facility_service_join": sql(PAIRED, "coord", "joined"),
    "facility_service_top": sql(
        PAIRED + """ ORDER BY country NULLS FIRST, facility_name NULLS FIRST, service_name NULLS FIRST,
 service_domain NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST LIMIT 20""", "coord", "joined"),
    "split_explode": f"""SELECT doc_id AS facility_code, 'clinical_services' AS service_category, item AS service_name
 FROM (SELECT doc_id, {SQUISH.format('line')} AS item
 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)) WHERE item <> ''""",
    "split_lists": f"""SELECT code AS facility_code, category AS service_category, item AS service_name FROM (
 SELECT code, category, {SQUISH.format('piece')} AS item FROM (
 SELECT code, category, unnest(string_split(items, ';')) AS piece FROM (
 SELECT p_partkey AS code, 'clinical_services' AS category, p_name || ';' || p_type AS items FROM part
 UNION ALL SELECT p_partkey, 'support_services', CASE WHEN p_partkey % 4 = 0 THEN NULL
 ELSE ' ' || p_brand || '  x ;; ' || p_name || ';' END FROM part
 UNION ALL SELECT p_partkey, 'diagnostic_services', CASE WHEN p_size < 25 THEN '' ELSE p_type END FROM part
 UNION ALL SELECT p_partkey, 'twenty_four_hour', 'Open ' || p_size FROM part))) WHERE item <> ''""",
    "json_props": "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "payload_facilities": f"""SELECT CASE WHEN turn % 5 <> 4 THEN role END AS facility_name, code AS new_facility_code,
 CASE WHEN turn % 2 = 0 THEN role END AS district, role AS sub_district, role AS facility_owner,
 CAST((conv_id % 90) || '.5' AS DOUBLE) AS latitude, CASE WHEN turn % 2 = 1 THEN 30.0::DOUBLE END AS longitude,
 turn % 3 = 0 AS always_open, 'old ' || role AS old_facility_code, 'c' || conv_id AS constituency,
 CASE WHEN turn % 2 = 1 THEN 'type ' || turn END AS service_delivery_type, '+' || conv_id AS telephone,
 CASE turn % 3 WHEN 0 THEN 'Urban' WHEN 1 THEN 'Rural' END AS urban_or_rural, 'open' AS facility_status,
 'published ' || turn AS publication_status, CAST(conv_id AS VARCHAR) AS catchment_area, '2026-01-0' || (1 + turn % 9) AS updated
 FROM ({PAYLOAD})""",
    "payload_services": f"""SELECT * FROM (
 SELECT code AS facility_code, 'clinical_services' AS service_category, unnest(string_split(text, chr(10))) AS service_name,
 CAST(NULL AS INTEGER) AS quantity, TRUE AS is_available FROM ({PAYLOAD})
 UNION ALL SELECT code, 'infrastructure', 'Water', NULL, TRUE FROM ({PAYLOAD}) WHERE turn % 2 = 0
 UNION ALL SELECT code, 'infrastructure', 'Power', NULL, TRUE FROM ({PAYLOAD}) WHERE conv_id % 2 = 0
 UNION ALL SELECT code, CASE WHEN turn % 2 = 0 THEN 'staff' ELSE 'infrastructure' END, 'Nurse', CAST(turn AS INTEGER),
 TRUE FROM ({PAYLOAD})
 UNION ALL SELECT code, 'infrastructure', 'Bed', CASE WHEN turn % 2 = 1 THEN 0 END, TRUE FROM ({PAYLOAD})
 WHERE conv_id % 3 = 0 AND conv_id % 2 = 1) WHERE service_name <> ''""",
    "facilities_plan": sql(
        f"""SELECT source_row, facility_code, facility_name, 'Tanzania' AS country, admin1, latitude, longitude,
 inside AS coordinate_valid, facility_type, ownership, status, open_date, {YEAR} AS open_year,
 TRY_CAST(trunc({t.number('catchment_population')}) AS INTEGER) AS catchment_population,
 coalesce(upper(inpatient) IN ('TRUE', 'YES', '1', 'Y'), FALSE) AS inpatient, 'Customer registry' AS data_source,
 CASE WHEN NOT inside OR facility_name IS NULL THEN 'low' WHEN facility_type IS NOT NULL THEN 'high'
 ELSE 'medium' END AS data_quality_flag
 FROM (SELECT *, {t.OPEN_DATE} AS open_date, latitude BETWEEN -12 AND 0 AND longitude BETWEEN 28 AND 41 AS inside
 FROM coord) WHERE latitude IS NOT NULL AND longitude IS NOT NULL""", "coord"),
    "csv_registry": sql(
        f"""SELECT CAST(source_row AS VARCHAR) AS source_row, nullif(facility_code, '') AS facility_code, iso, country,
 {WRITTEN_NAME} AS facility_name, admin1, admin2, facility_type, ownership_raw, nullif(latitude, '') AS latitude,
 longitude, open_date_raw, status, catchment_population, inpatient FROM fac""", "fac"),
    "lake_tables": sql(
        """SELECT source_row, facility_name, CASE WHEN country = 'Kenya' THEN 'unknown' ELSE data_quality_flag END
 AS data_quality_flag, country, DATE '2026-01-31' AS extraction_date FROM quality""", "quality"),
    "uid_registry": sql(
        f"SELECT country, facility_code, uid, created_date FROM reg UNION ALL BY NAME SELECT * FROM ({MINTED})", "reg"),
    "services_plan": sql(SERVICES, "svc", "cw", "reg1"),
    "services_slim": sql(
        f"""SELECT facility_uid, facility_code, country_iso, country_name, {SERVICE_COLUMNS}, source_category_id,
 source_service_name, {FLAG_COLUMNS} FROM ({SERVICES})""", "svc", "cw", "reg1"),
}

# State tables and runs, written and read back.
ORACLES["registry_versions"] = sql("""SELECT CAST(v AS INTEGER) AS version, country, count(*) AS n_rows, count(*) AS n_uids
 FROM (VALUES (0), (1), (2), (3)) AS versions(v) JOIN (SELECT country, -1 AS run FROM reg
 UNION ALL SELECT n.country, n.run FROM (SELECT iso AS country, facility_code, min(source_row % 3) AS run FROM fac WHERE facility_code <> ''
 GROUP BY iso, facility_code) n WHERE NOT EXISTS (SELECT 1 FROM reg r WHERE r.country = n.country AND r.facility_code = n.facility_code)) k
 ON k.run < v GROUP BY v, country""", "fac", "reg")
ORACLES["geocode_landed"] = sql(f"""SELECT source_row, geocode_query, CASE WHEN geocode_query IS NULL THEN NULL
 WHEN known AND result_lat IS NULL THEN 'failed' ELSE 'cached' END AS geocode_status,
 CASE WHEN geocode_query IS NOT NULL AND NOT known THEN length(geocode_query) + 0.5 WHEN result_lat IS NOT NULL THEN result_lat
 ELSE latitude END::DOUBLE AS latitude, CASE WHEN geocode_query IS NOT NULL AND NOT known THEN 0.25
 WHEN result_lat IS NOT NULL THEN result_lon ELSE longitude END::DOUBLE AS longitude,
 CASE WHEN (geocode_query IS NOT NULL AND NOT known) OR result_lat IS NOT NULL THEN 'OSM' END AS coordinate_source
 FROM ({GEOCODED})""", "coord", "cache")
ORACLES["services_run"] = ORACLES["services_plan"]
ORACLES["services_log"] = sql("""SELECT 'GLOBAL' AS country, 'services TZA' AS step, 'SUCCESS' AS status, count(*) AS n_rows FROM svc
 UNION ALL SELECT 'GLOBAL', 'services KEN', 'FAILED', NULL UNION ALL SELECT 'GLOBAL', 'services', 'SUCCESS', NULL""", "svc")

# The same results by way of a table of rules or a written copy.
ORACLES["rule_table"] = f"""SELECT doc_id, {name_rule_columns('category', 'text')} FROM (SELECT doc_id, text,
 'clinical_services' AS category FROM documents)"""
ORACLES["crosswalk_built"] = ORACLES["rule_names"]
ORACLES["payload_prepared"] = ORACLES["payload_facilities"]
ORACLES["wide_prepared"] = ORACLES["split_lists"]


# Great circles by another way: the latitude at which an arc passes the point's meridian.
WEST, EAST = "((x1 - v.longitude + 540) % 360 - 180)", "((x2 - v.longitude + 540) % 360 - 180)"
PASSES = f"(({WEST} < 0) <> ({EAST} < 0) AND abs({WEST} - {EAST}) < 180)"
PASSED = "degrees(atan((tan(radians(y1)) * sin(radians(x2 - {lon})) + tan(radians(y2)) * sin(radians({lon} - x1))) / sin(radians(x2 - x1))))"
INSIDE_SPHERE = f"""SELECT v.*, v.country IN (SELECT country FROM {{edges}}) AS covered,
 (SELECT count(*) FROM {{edges}} e WHERE e.country = v.country AND {PASSES}
 AND {PASSED.format(lon='v.longitude')} > v.latitude) % 2 = 1 AS odd,
 EXISTS (SELECT 1 FROM {{edges}} e WHERE e.country = v.country
 AND ((x1 = v.longitude AND x2 = v.longitude AND v.latitude BETWEEN least(y1, y2) AND greatest(y1, y2))
 OR (x1 <> x2 AND v.longitude BETWEEN least(x1, x2) AND greatest(x1, x2)
 AND abs({PASSED.format(lon='v.longitude')} - v.latitude) < 1e-10))) AS touching FROM {{points}} v"""
ORACLES["within_flag_sphere"] = sql(
    f"""SELECT source_row, country, CASE WHEN latitude IS NULL OR longitude IS NULL THEN NULL
 WHEN NOT covered THEN coordinate_valid ELSE coordinate_valid AND odd AND NOT touching END AS coordinate_valid
 FROM ({INSIDE_SPHERE.format(edges='edges', points='valid')})""", "valid", "edges")
WORLD = "(SELECT * FROM (VALUES " + ", ".join(f"('{e[0]}', " + ", ".join(f"{x}::DOUBLE" for x in e[1:]) + ")" for e in t.WORLD_EDGES) + ") w(country, x1, y1, x2, y2))"
GLOBE = """(SELECT c_custkey, country, CAST(c_custkey * 7919 % 17951 AS DOUBLE) / 100 - 89.755 AS latitude,
 CAST(c_custkey * 104729 % 35993 AS DOUBLE) / 100 - 179.965 AS longitude
 FROM customer, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS country))"""
ORACLES["within_sphere_world"] = f"""SELECT c_custkey, country, CASE WHEN covered THEN FALSE END AS on_boundary,
 CASE WHEN covered THEN odd <> (country = 'C') END AS in_interior
 FROM ({INSIDE_SPHERE.format(edges=WORLD, points=GLOBE)})"""


ORACLES["rules_indexed"] = """WITH rules AS (SELECT * FROM (
 SELECT min(p_partkey) AS rule_id, '\\b' || p_name || ' (economy|large|promo).*#1[0-9]?$|^none ' || p_name AS pattern,
 upper(p_name) AS domain FROM part GROUP BY p_name UNION ALL
 SELECT min(p_partkey) + 1000000000, lower(p_brand) || '$', p_brand FROM part GROUP BY p_brand) WHERE rule_id % 5 <> 0),
 named AS (SELECT p_partkey, p_type, concat_ws(' ', p_name, p_type, p_brand) AS name FROM part),
 hits AS (SELECT n.name, min(r.rule_id) AS rule_id FROM (SELECT DISTINCT name FROM named) n
 JOIN rules r ON regexp_matches(lower(n.name), r.pattern) GROUP BY 1)
 SELECT p_partkey, p_type, name, coalesce(r.domain, CASE WHEN p_type <> 'ECONOMY' THEN lower(p_type) END) AS domain
 FROM named LEFT JOIN hits h USING (name) LEFT JOIN rules r ON r.rule_id = h.rule_id"""
ORACLES["facility_uid_join_bucketed"] = ORACLES["facility_uid_join"]
CHANGED = """SELECT country, facility_name, facility_code, admin1, CASE WHEN country <> 'Kenya' THEN latitude END AS latitude,
 CASE WHEN country = 'Kenya' THEN 'unknown' ELSE data_quality_flag END AS data_quality_flag FROM quality"""
ORACLES["stored_quality"] = sql(
    f"""SELECT country, coalesce(data_quality_flag, '(null)') AS data_quality_flag, count(*) AS n_facilities,
 round({percent('count(*)', 'sum(count(*)) OVER (PARTITION BY country)')}, 1) AS pct_of_country
 FROM ({CHANGED}) GROUP BY 1, 2""", "quality")
ORACLES["stored_completeness"] = sql(
    " UNION ALL ".join(
        f"""SELECT country, '{c}' AS column_name, count({c}) AS non_null, count(*) AS n_rows,
 round_even(100.0::DOUBLE - round_even({percent(f'count(*) - count({c})', 'count(*)')}, 1), 1) AS pct_non_null
 FROM ({CHANGED}) GROUP BY country""" for c in ("facility_name", "facility_code", "admin1", "latitude")), "quality")
ORACLES["distinct_sketches"] = sql(
    " UNION ALL ".join(
        f"SELECT country, '{c}' AS column_name, count(DISTINCT {c}) AS n_exact, TRUE AS within FROM fac GROUP BY country"
        for c in ("facility_name", "admin1")), "fac")
ORACLES["services_counters"] = sql("""SELECT 'TZA' AS country, 'services' AS step, unnest(['rows', 'matched', 'unmatched']) AS counter,
 unnest([count(*), count(facility_uid), count(*) - count(facility_uid)]) AS n
 FROM (SELECT CASE WHEN country_iso = 'TZA' THEN facility_uid END AS facility_uid FROM joined)""", "joined")
