"""The given tables dressed up as facility registries and service lists.

FAC, SVC, CW and REG are plain projections of customer, lineitem, orders and part,
with every irregularity the operators have to handle. ``SQL`` holds the same
projections for the other engine.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.operators.lookups import partitions_of

# Remainder of the customer key by 16 -> country; the first holds over a third of all rows.
COUNTRY_CASE = """CASE WHEN {k} % 16 < 6 THEN 'Tanzania' WHEN {k} % 16 < 9 THEN 'Kenya'
 WHEN {k} % 16 < 11 THEN 'Ethiopia' WHEN {k} % 16 = 11 THEN 'Malawi' WHEN {k} % 16 = 12 THEN 'Botswana'
 WHEN {k} % 16 = 13 THEN 'Uganda' WHEN {k} % 16 = 14 THEN 'Zambia' ELSE 'Nigeria' END"""
ISO_CASE = """CASE WHEN {k} % 16 < 6 THEN 'TZA' WHEN {k} % 16 < 9 THEN 'KEN'
 WHEN {k} % 16 < 11 THEN 'ETH' WHEN {k} % 16 = 11 THEN 'MWI' WHEN {k} % 16 = 12 THEN 'BWA'
 WHEN {k} % 16 = 13 THEN 'UGA' WHEN {k} % 16 = 14 THEN 'ZMB' ELSE 'NGA' END"""

CODE = "CASE WHEN {k} % 101 = 5 THEN NULL WHEN {k} % 103 = 7 THEN '' ELSE CAST({k} AS {text}) END"
NAME = "CASE WHEN {k} % 29 = 0 THEN NULL ELSE c_name END"
ADMIN1 = "CASE WHEN {k} % 23 = 0 THEN NULL ELSE r_name END"
TYPE = "CASE WHEN {k} % 31 = 0 THEN NULL ELSE c_mktsegment END"
OWNER = """CASE {k} % 7 WHEN 0 THEN 'Government of the Region' WHEN 1 THEN 'Private NGO' WHEN 2 THEN 'For PROFIT company'
 WHEN 3 THEN 'Mission hospital' WHEN 4 THEN 'Govt' WHEN 5 THEN NULL ELSE 'private clinic' END"""
CENTS = """CASE WHEN {c} < 0 THEN '-' ELSE '' END || CAST({whole} AS {text}) || '.'
 || lpad(CAST(abs({c}) % 100 AS {text}), 2, '0')"""
LAT = """CASE WHEN {k} % 17 = 0 THEN NULL WHEN {k} % 37 = 0 THEN '' WHEN {k} % 41 = 0 THEN '12,5'
 WHEN {k} % 43 = 0 THEN ' -6.25 ' WHEN {k} % 47 = 0 THEN 'NaN' WHEN {k} % 53 = 0 THEN '1.5d'
 WHEN {k} % 59 = 0 THEN '95.50' ELSE {lat} END"""
LON = "CASE WHEN {k} % 61 = 0 THEN NULL WHEN {k} % 67 = 0 THEN '-190.25' ELSE {lon} END"
OPENED = """CASE {k} % 11 WHEN 0 THEN '12apr2005' WHEN 1 THEN '1APR2015' WHEN 2 THEN '2004-01-05'
 WHEN 3 THEN '2004-1-5' WHEN 4 THEN '2011-07-09T10:11:12' WHEN 5 THEN '01jan1970' WHEN 6 THEN '1970-01-01'
 WHEN 7 THEN '1850-06-01' WHEN 8 THEN '2090-01-01' WHEN 9 THEN '2004-02-30' ELSE 'unknown' END"""
STATUS = "CASE {k} % 3 WHEN 0 THEN 'Operating' WHEN 1 THEN 'Closed' ELSE NULL END"
CATCHMENT = """CASE {k} % 5 WHEN 0 THEN CAST({k} AS {text}) WHEN 1 THEN '12.7' WHEN 2 THEN '3e9'
 WHEN 3 THEN 'n/a' ELSE NULL END"""
INPATIENT = """CASE {k} % 6 WHEN 0 THEN 'yes' WHEN 1 THEN 'Y' WHEN 2 THEN '1' WHEN 3 THEN 'no'
 WHEN 4 THEN NULL ELSE 'true' END"""


def _facility_columns(text: str, divide: str) -> dict[str, str]:
    k = "c_custkey"

    def fill(template: str, **extra) -> str:
        return template.format(k=k, text=text, **extra)

    lat_c, lon_c = f"(({k} * 7919) % 5200 - 3100)", f"(({k} * 104729) % 5200)"
    lat = fill(CENTS, c=lat_c, whole=divide.format(a=f"abs({lat_c})", b=100))
    lon = fill(CENTS, c=lon_c, whole=divide.format(a=f"abs({lon_c})", b=100))
    return {
        "source_row": k,
        "balance": "c_acctbal",
        "facility_code": fill(CODE),
        "facility_name": fill(NAME),
        "country": fill(COUNTRY_CASE),
        "iso": fill(ISO_CASE),
        "admin1": fill(ADMIN1),
        "admin2": "n_name",
        "facility_type": fill(TYPE),
        "ownership_raw": fill(OWNER),
        "latitude": fill(LAT, lat=lat),
        "longitude": fill(LON, lon=lon),
        "open_date_raw": fill(OPENED),
        "status": fill(STATUS),
        "catchment_population": fill(CATCHMENT),
        "inpatient": fill(INPATIENT),
    }


DETAIL = """CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 20 = 1 THEN '  ' || p_name || {tab}
 ELSE p_name END"""
DOMAIN = """CASE WHEN p_name LIKE '% gizmo' THEN 'Malaria Services' WHEN p_type = 'STANDARD' THEN 'Clinical Services'
 WHEN p_type = 'ECONOMY' THEN 'Support Services' WHEN p_type = 'SMALL' THEN 'Diagnostic Services'
 WHEN p_type = 'LARGE' THEN 'Reproductive & Maternal Health' WHEN p_type = 'PROMO' THEN 'Community & Preventive Health'
 ELSE 'HIV/AIDS Services' END"""
GROUP = "CASE WHEN p_name IS NULL THEN 'Unspecified' ELSE substr(p_name, 1, 3) END"
INCLUDE = "CASE WHEN p_name LIKE '% plate' THEN NULL ELSE p_type <> 'ECONOMY' END"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FAC: one registry over all countries, every value as text."""
    people = (
        read(spark, sf_dir, "customer")
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    columns = _facility_columns("string", "{a} div {b}")
    return people.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def raw_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SVC: one service list; the first four columns tell all different rows apart."""
    lines, orders = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "orders")
    parts = partitions_of(lines, 1024)
    if parts:  # large tables: both are dealt to as many parts, so that no task sorts more of them than of smaller ones
        lines, orders = lines.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    return (
        lines
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            F.col("o_custkey").cast("string").alias("facility_code"),
            F.expr(ISO_CASE.format(k="o_custkey")).alias("country_iso"),
            F.col("p_type").alias("service_category"),
            F.expr(DETAIL.format(tab="'\\t'")).alias("service_detail"),
        )
    )


SERVICE_ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CW: the parts vocabulary without "rod", and one NULL detail per category."""
    part = read(spark, sf_dir, "part").select("p_type", "p_name").distinct()
    empty = part.select("p_type").distinct().withColumn("p_name", F.lit(None).cast("string"))
    return part.filter("p_name NOT LIKE '% rod'").unionByName(empty).select(
        F.col("p_type").alias("source_category"),
        F.col("p_name").alias("source_detail"),
        F.expr(DOMAIN).alias("service_domain"),
        F.expr(GROUP).alias("service_group"),
        F.upper("p_name").alias("service_name"),
        F.expr("p_type <> 'ECONOMY'").alias("is_clinical"),
        F.expr("coalesce(p_name LIKE '% gizmo', false)").alias("is_malaria_related"),
        F.expr(INCLUDE).alias("include_in_analysis"),
        F.expr("coalesce(p_name LIKE '% anvil', false)").alias("needs_review"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REG: identifiers of the codes with a balance from 2,000, some given out twice."""
    rows = raw_facilities(spark, sf_dir).filter("balance >= 2000 AND facility_code <> ''")
    number = F.explode(F.expr(
        "CASE WHEN source_row % 30 = 1 THEN array(source_row, source_row + 5000000) ELSE array(source_row) END"
    ))
    return rows.select("iso", "facility_code", "source_row", number.alias("number")).select(
        F.col("iso").alias("country"),
        "facility_code",
        F.format_string("%s-%06d", F.col("iso"), F.col("number")).alias("uid"),
        F.expr("date_add(DATE'2024-01-01', CAST(source_row % 365 AS INT))").alias("created_date"),
    )


def geocode_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups of the facilities without latitude and below a balance: found, not found, repeated."""
    rows = raw_facilities(spark, sf_dir).filter("latitude IS NULL AND balance < 6000")
    return rows.select(
        F.expr("concat_ws(', ', facility_name, admin1, country)").alias("query"),
        F.expr("CASE WHEN source_row % 2 = 0 THEN NULL ELSE CAST(source_row % 10 AS DOUBLE) + 0.5 END").alias("result_lat"),
        F.expr("CASE WHEN source_row % 2 = 0 THEN NULL ELSE CAST(source_row % 40 AS DOUBLE) + 0.25 END").alias("result_lon"),
        F.lit("clinic").alias("result_type"),
    )


def _ring(country: str, corners: list[tuple[float, float]]) -> list[tuple]:
    closed = [*corners, corners[0]]
    return [(country, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(closed, closed[1:])]


# Coarse test boundaries (longitude, latitude): a convex one, one with a hole, one in two parts.
EDGES = (
    _ring("Tanzania", [(29, -3), (34, -1), (40, -5), (39, -11), (32, -9)])
    + _ring("Kenya", [(34, -4), (41, -4), (41, 5), (34, 5)])
    + _ring("Kenya", [(36, -1), (38, -1), (38, 2), (36, 2)])
    + _ring("Ethiopia", [(34, 4), (38, 4), (36, 14)])
    + _ring("Ethiopia", [(40, 4), (47, 6), (42, 12)])
)


def boundary_edges(spark: SparkSession) -> DataFrame:
    names = ("country", "x1", "y1", "x2", "y2")
    return spark.createDataFrame(pa.table({n: [e[i] for e in EDGES] for i, n in enumerate(names)}))


# Large test polygons: a northern edge that bulges far north, one with a hole across the date line, one around each pole.
WORLD_EDGES = (
    _ring("A", [(-60, 40), (60, 40), (60, 10), (-60, 10)])
    + _ring("B", [(170, -20), (-170, -20), (-165, 5), (172, 8)])
    + _ring("B", [(178, -10), (-178, -10), (-178, -5), (178, -5)])
    + _ring("C", [(1, 70), (91, 65), (178, 70), (-90, 60)])
    + _ring("D", [(-120, -50), (1, -45), (120, -55)])
)


def world_edges(spark: SparkSession) -> DataFrame:
    names = ("country", "x1", "y1", "x2", "y2")
    return spark.createDataFrame(pa.table({n: [e[i] for e in WORLD_EDGES] for i, n in enumerate(names)}))


def world_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point for every customer and polygon, and for a country without one."""
    return read(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(F.array(*map(F.lit, "ABCDE"))).alias("country"),
        F.expr("CAST(c_custkey * 7919 % 17951 AS DOUBLE) / 100 - 89.755").alias("latitude"),
        F.expr("CAST(c_custkey * 104729 % 35993 AS DOUBLE) / 100 - 179.965").alias("longitude"),
    )


# Corners of polygons around (x0, y0), in whole degrees: outer ring, hole, a part of its own, and a ring that crosses itself.
OUTER, HOLE = [(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (1, 3), (3, 3), (3, 1)]
ISLAND, BOW = [(6, 0), (8, 0), (7, 3)], [(0, 0), (4, 4), (4, 0), (0, 4)]
X0, Y0 = "(c_custkey * 37 % 300 - 150)", "(c_custkey * 53 % 120 - 60)"


def _corner_text(corners: list, between: str, around: tuple[str, str], closed: bool = True) -> str:
    """SQL of a ring's text from its corners."""
    ring = [*corners, corners[0]] if closed else corners
    points = f" || '{around[1]},{around[0]}' || ".join(
        f"CAST({X0} + {x} AS STRING) || '{between}' || CAST({Y0} + {y} AS STRING)" for x, y in ring)
    return f"'{around[0]}' || {points} || '{around[1]}'"


def _wkt(corners: list, closed: bool = True) -> str:
    return f"'(' || {_corner_text(corners, ' ', ('', ''), closed)} || ')'"


def _json(corners: list) -> str:
    return f"'[' || {_corner_text(corners, ',', ('[', ']'))} || ']'"


def polygon_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon with a hole per customer, every fifth with an island, as WKT (even keys) or GeoJSON: country, document."""
    hole, island = f"{_wkt(OUTER)} || ',' || {_wkt(HOLE)}", _wkt(ISLAND)
    wkt = f"""CASE WHEN c_custkey % 5 = 0 THEN 'MULTIPOLYGON((' || {hole} || '),(' || {island} || '))'
 ELSE 'SRID=4326;POLYGON (' || {hole} || ')' END"""
    hole, island = f"{_json(OUTER)} || ',' || {_json(HOLE)}", _json(ISLAND)
    geometry = f"""CASE WHEN c_custkey % 5 = 0 THEN '{{"type":"MultiPolygon","coordinates":[[' || {hole} || '],[' || {island} || ']]}}'
 ELSE '{{"type":"Polygon","coordinates":[' || {hole} || ']}}' END"""
    feature = f"""'{{"type":"Feature","properties":{{"key":"' || CAST(c_custkey AS STRING) || '"}},"geometry":' || {geometry} || '}}'"""
    text = F.expr(f"CASE WHEN c_custkey % 2 = 0 THEN {wkt} ELSE {feature} END")
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("country"), text.alias("document"))


def ring_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ring per customer as WKT: crossing itself, open, right, or with a coordinate that is no number: country, document."""
    text = F.expr(f"""CASE c_custkey % 4 WHEN 0 THEN 'POLYGON(' || {_wkt(BOW)} || ')' WHEN 1 THEN 'POLYGON(' || {_wkt(OUTER, False)} || ')'
 WHEN 2 THEN 'POLYGON(' || {_wkt(OUTER)} || ')' ELSE 'POLYGON((0 0, 4 x, 4 4, 0 0))' END""")
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("country"), text.alias("document"))


def boundary_features(spark: SparkSession) -> DataFrame:
    """The test boundaries as GeoJSON, one feature a ring: value."""
    corners: dict[tuple, list] = {}
    start = None
    for country, x1, y1, x2, y2 in EDGES:
        start = start or (country, x1, y1)
        corners.setdefault(start, []).append([x1, y1])
        start = None if (x2, y2) == start[1:] else start
    features = [
        {"type": "Feature", "properties": {"name": k[0]}, "geometry": {"type": "Polygon", "coordinates": [[*c, c[0]]]}} for k, c in corners.items()
    ]
    return spark.createDataFrame(pa.table({"value": [json.dumps(f) for f in features]}))


def _with(name: str, body: str) -> str:
    return f"{name} AS ({body})"


_FAC = "SELECT " + ", ".join(
    f"{e} AS {c}" for c, e in _facility_columns("VARCHAR", "{a} // {b}").items()
) + """ FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

NUMBER_SQL = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def number(column: str) -> str:
    trimmed = f"trim({column}, ' ' || chr(9) || chr(10) || chr(13))"
    return f"CASE WHEN regexp_matches({trimmed}, '{NUMBER_SQL}') THEN TRY_CAST({trimmed} AS DOUBLE) END"


_BOXES = """SELECT * FROM (VALUES ('Tanzania', -12, 0, 28, 41), ('Uganda', -2, 5, 29, 36), ('Zambia', -19, -7, 21, 35),
 ('Malawi', -18, -8, 32, 37), ('Nigeria', 3, 15, 2, 16), ('Botswana', -28, -17, 19, 30), ('Kenya', -5, 6, 33, 42),
 ('Ethiopia', 3, 15, 33, 48)) AS t(box_country, lat_min, lat_max, lon_min, lon_max)"""

_OWNERSHIP = """CASE
 WHEN regexp_matches(ownership_raw, '(?i)public|government|lga|moh|military|police|prison|parastatal') THEN 'Public'
 WHEN regexp_matches(ownership_raw, '(?i)faith|fbo|church|mission|religious|ngo') THEN 'Faith-Based / NGO'
 WHEN regexp_matches(ownership_raw, '(?i)private|profit|company|investor|business|clinic') THEN 'Private'
 ELSE 'Other' END"""

_COORD = f"""SELECT fac.* EXCLUDE (latitude, longitude), {number('latitude')} AS latitude,
 {number('longitude')} AS longitude, {_OWNERSHIP} AS ownership FROM fac"""

_VALID = """SELECT coord.*, CASE WHEN latitude IS NULL OR longitude IS NULL THEN NULL
 WHEN latitude < -90 OR latitude > 90 OR longitude < -180 OR longitude > 180 THEN FALSE
 WHEN latitude < lat_min OR latitude > lat_max OR longitude < lon_min OR longitude > lon_max THEN FALSE
 ELSE TRUE END AS coordinate_valid FROM coord JOIN boxes ON box_country = country"""

_QUALITY = """SELECT *, CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'low' WHEN NOT coordinate_valid THEN 'low'
 WHEN facility_name IS NULL THEN 'low'
 WHEN coordinate_valid AND facility_type IS NOT NULL AND ownership IS NOT NULL THEN 'high'
 WHEN coordinate_valid THEN 'medium' ELSE 'unknown' END AS data_quality_flag FROM valid"""

OPEN_DATE = """nullif(coalesce(CAST(try_strptime(open_date_raw, '%d%b%Y') AS DATE),
 CAST(try_strptime(substr(open_date_raw, 1, 10), '%Y-%m-%d') AS DATE)), DATE '1970-01-01')"""

_DATES = f"SELECT *, {OPEN_DATE} AS open_date FROM fac"

_SVC = f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(o_custkey AS VARCHAR) AS facility_code,
 {ISO_CASE.format(k='o_custkey')} AS country_iso, p_type AS service_category,
 {DETAIL.format(tab='chr(9)')} AS service_detail
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""

_CW = f"""SELECT p_type AS source_category, p_name AS source_detail, {DOMAIN} AS service_domain, {GROUP} AS service_group,
 upper(p_name) AS service_name, p_type <> 'ECONOMY' AS is_clinical,
 coalesce(p_name LIKE '% gizmo', FALSE) AS is_malaria_related, {INCLUDE} AS include_in_analysis,
 coalesce(p_name LIKE '% anvil', FALSE) AS needs_review
 FROM (SELECT DISTINCT p_type, p_name FROM part WHERE p_name NOT LIKE '% rod'
 UNION ALL SELECT DISTINCT p_type, CAST(NULL AS VARCHAR) FROM part)"""

_REG = """SELECT iso AS country, facility_code, printf('%s-%06d', iso, number) AS uid,
 DATE '2024-01-01' + CAST(source_row % 365 AS INTEGER) AS created_date
 FROM (SELECT iso, facility_code, source_row, unnest(CASE WHEN source_row % 30 = 1
 THEN [source_row, source_row + 5000000] ELSE [source_row] END) AS number
 FROM fac WHERE balance >= 2000 AND facility_code <> '')"""

_REG1 = """SELECT country, facility_code, min_by(uid, (length(uid), uid)) AS uid FROM reg
 GROUP BY country, facility_code"""

_CACHE = """SELECT concat_ws(', ', facility_name, admin1, country) AS query,
 CASE WHEN source_row % 2 = 0 THEN NULL ELSE CAST(source_row % 10 AS DOUBLE) + 0.5 END AS result_lat,
 CASE WHEN source_row % 2 = 0 THEN NULL ELSE CAST(source_row % 40 AS DOUBLE) + 0.25 END AS result_lon
 FROM fac WHERE latitude IS NULL AND balance < 6000"""

_EDGES = "SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', {x1}::DOUBLE, {y1}::DOUBLE, {x2}::DOUBLE, {y2}::DOUBLE)" for c, x1, y1, x2, y2 in EDGES
) + ") AS t(country, x1, y1, x2, y2)"

_TRIMMED = "trim({c}, ' ' || chr(9) || chr(10) || chr(13))"

# Service rows with hierarchy, flags and facility identifier.
_JOINED = f"""SELECT s.* EXCLUDE (service_detail), {_TRIMMED.format(c='s.service_detail')} AS source_service_name,
 c.service_domain, c.service_group, c.service_name, c.is_clinical, c.is_malaria_related, c.include_in_analysis,
 c.needs_review, r.uid AS facility_uid
 FROM svc s LEFT JOIN cw c ON s.service_category IS NOT DISTINCT FROM c.source_category
 AND {_TRIMMED.format(c='s.service_detail')} IS NOT DISTINCT FROM c.source_detail
 LEFT JOIN reg1 r ON r.country = s.country_iso AND r.facility_code = s.facility_code"""

_PARTS = {
    "fac": (_FAC, []),
    "boxes": (_BOXES, []),
    "coord": (_COORD, ["fac"]),
    "valid": (_VALID, ["coord", "boxes"]),
    "quality": (_QUALITY, ["valid"]),
    "dated": (_DATES, ["fac"]),
    "svc": (_SVC, []),
    "cw": (_CW, []),
    "reg": (_REG, ["fac"]),
    "reg1": (_REG1, ["reg"]),
    "cache": (_CACHE, ["fac"]),
    "edges": (_EDGES, []),
    "joined": (_JOINED, ["svc", "cw", "reg1"]),
}


def sql(body: str, *needs: str) -> str:
    """``body`` behind the named projections and whatever they build on."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for parent in _PARTS[name][1]:
            add(parent)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(_with(n, _PARTS[n][0]) for n in ordered) + "\n" + body
