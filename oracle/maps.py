"""SQL twins of the queries on geometry, viewports and map documents."""

from __future__ import annotations

from oracle import properties, texts  # noqa: F401  (their fragments are used here)
from oracle.base import fragment, half_up, query


def _n(expr: str) -> str:
    return rf"regexp_replace(CAST({expr} AS VARCHAR), '\.0$', '')"


def _pairs(open_: str, sep: str, close: str, number, corners: str = "00 10 11 01 00") -> str:
    def corner(c: str) -> str:
        x = "x0 + 0.9" if c[0] == "1" else "x0"
        y = "y0 + 0.9" if c[1] == "1" else "y0"
        return f"'{open_}' || {number(x)} || '{sep}' || {number(y)} || '{close}'"

    return corners.split(), corner


def _wkt(corners: str = "00 10 11 01 00") -> str:
    names, corner = _pairs("", " ", "", _n, corners)
    return "'MULTIPOLYGON (((' || " + " || ', ' || ".join(corner(c) for c in names) + " || ')))'"


def _triangles() -> str:
    """The two halves of a square whose ring takes its corners crosswise."""
    _, corner = _pairs("", " ", "", _n)
    middle = f"{_n('x0 + 0.5 * (x0 + 0.9 - x0)')} || ' ' || {_n('y0 + 0.5 * (y0 + 0.9 - y0)')}"
    halves = [[corner("00"), middle, corner("01"), corner("00")], [middle, corner("10"), corner("11"), middle]]
    return "'MULTIPOLYGON (((' || " + " || ')), ((' || ".join(" || ', ' || ".join(half) for half in halves) + " || ')))'"


_BOW = _triangles()


def _coordinates() -> str:
    names, corner = _pairs("[", ",", "]", lambda e: f"CAST({e} AS VARCHAR)")
    return "'[[[' || " + " || ',' || ".join(corner(c) for c in names) + " || ']]]'"


_GEOJSON = """'{"type":"MultiPolygon","coordinates":' || """ + _coordinates() + " || '}'"
_HUE = "(1 - GREATEST(0.0, LEAST(1.0, (satisfaction - 5.0) / -2.5))) * 180"
_LIGHT = "20 + GREATEST(0.0, LEAST(1.0, (satisfaction - 5.0) / -2.5)) * 40"

fragment(
    "f_viewports",
    """SELECT c_custkey view_id, CAST(c_custkey % 15 + 1 AS INTEGER) zoom, -5 + CAST(c_custkey % 140 AS DOUBLE) / 10 sw_lon,
       42 + CAST(c_custkey % 80 AS DOUBLE) / 10 sw_lat FROM customer""",
)
fragment(
    "f_rated",
    "SELECT city_id, mean satisfaction FROM f_city_docs WHERE review_count > 0",
)
# A parent area is the set of its cities' squares.
fragment(
    "f_shapes",
    """SELECT 'city' AS level, city_id area_id, name, x0, y0 FROM f_cities
UNION ALL SELECT DISTINCT 'department', d.department_id, d.name, c.x0, c.y0
FROM f_cities c JOIN f_departments d ON d.department_id = c.department_id
UNION ALL SELECT DISTINCT 'region', r.region_id, r.name, c.x0, c.y0
FROM f_cities c JOIN f_regions r ON r.region_id = c.region_id""",
)
fragment(
    "f_level_stats",
    """SELECT 'city' AS level, city_id area_id, price_m2_mean, price_min, price_max FROM f_city_stats
UNION ALL SELECT 'department', department_id, price_m2_mean, price_min, price_max FROM f_department_stats
UNION ALL SELECT 'region', region_id, price_m2_mean, price_min, price_max FROM f_region_stats""",
)


def _features(level: str, box: tuple[float, float, float, float], parent: str = "a.area_id", keep: str = "true", table: str = "") -> str:
    """Map rows of a level that meet (sw_lat, sw_lon, ne_lat, ne_lon)."""
    s_lat, s_lon, n_lat, n_lon = box
    path = {"city": "cities", "department": "departments", "region": "regions"}[level]
    rating = "q.satisfaction" if level == "city" else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{level}' AS level, a.area_id, {parent} AS agglomeration_id, a.name,
       CASE WHEN s.price_m2_mean >= 500 THEN s.price_m2_mean END AS price, s.price_max AS max_price,
       s.price_min AS min_price, {rating} AS satisfaction,
       'api/v1/word-clouds/{path}/' || {parent} AS word_cloud_url, 'api/v1/sentiments/{path}/' || {parent} AS sentiments_url,
       a.polygons, a.x0, a.y0
FROM (SELECT area_id, name, CAST(COUNT(*) AS INTEGER) polygons, MIN(x0) x0, MIN(y0) y0 FROM f_shapes WHERE level = '{level}'
      GROUP BY area_id, name
      HAVING bool_or(x0 <= {n_lon} AND x0 + 0.9 >= {s_lon} AND y0 <= {n_lat} AND y0 + 0.9 >= {s_lat})) a
LEFT JOIN (SELECT * FROM f_level_stats WHERE level = '{level}') s ON s.area_id = a.area_id
LEFT JOIN f_rated q ON q.city_id = a.area_id {table} WHERE {keep}"""


_WORLD = (-90, -180, 90, 180)
_VIEW_COLUMNS = (
    "level, area_id, agglomeration_id, name, price, max_price, min_price, satisfaction, word_cloud_url, sentiments_url, polygons"
)


def _view(level: str, box) -> str:
    return query(f"SELECT {_VIEW_COLUMNS} FROM ({_features(level, box)})")


def _json(name: str, column: str, text: bool = False) -> str:
    value = f"""'"' || {column} || '"'""" if text else f"CAST({column} AS VARCHAR)"
    return f"""'"{name}":' || COALESCE({value}, 'null')"""


_PROPERTIES = " || ',' || ".join(
    [
        _json("id", "area_id", True), _json("agglomeration_id", "agglomeration_id", True), _json("name", "name", True),
        _json("price", "price"), _json("max_price", "max_price"), _json("min_price", "min_price"),
        _json("satisfaction", "satisfaction"), _json("word_cloud_url", "word_cloud_url", True),
        _json("sentiments_url", "sentiments_url", True),
    ]
)
_FEATURE = f"""'{{"type":"Feature","properties":{{' || {_PROPERTIES} || '}},"geometry":' || {_GEOJSON} || '}}'"""
_LATEST = """SELECT * FROM f_transactions WHERE price >= 500 AND lon > 1 AND lon < 2 AND lat > 44 AND lat < 45
ORDER BY tx_date DESC, tx_id, parcel_id, price, built_area NULLS FIRST, land_area NULLS FIRST, lon, lat LIMIT 750"""
_POINT = """'{"type":"Point","coordinates":[' || CAST(lon AS VARCHAR) || ',' || CAST(lat AS VARCHAR) || ']}'"""
_SALE = (
    """'{"type":"Feature","properties":{' || """
    + " || ',' || ".join(
        [
            _json("date", "strftime(tx_date, '%Y-%m-%d')", True), _json("price", "price"),
            _json("built_area", "built_area"), _json("land_area", "land_area"),
        ]
    )
    + """ || '},"geometry":' || """
    + _POINT
    + " || '}'"
)

ORACLE = {
    "g1_parse_coordinates": query(f"SELECT city_id, {_wkt()} AS wkt FROM f_cities"),
    "g2_as_multipolygon": query(f"SELECT city_id, {_wkt()} AS wkt FROM f_cities"),
    "g3_repair_rings": query(
        f"""SELECT city_id, CASE WHEN CAST(city_id AS BIGINT) % 7 = 0 THEN {_BOW} ELSE {_wkt()} END AS wkt, true AS simple,
       CAST(city_id AS BIGINT) % 7 = 0 AS repaired FROM f_cities"""
    ),
    "g4_to_wkt": query(f"SELECT city_id, {_wkt()} AS wkt FROM f_cities"),
    "g5_from_wkt": query("SELECT city_id, x0 AS min_x, y0 AS min_y, x0 + 0.9 AS max_x, y0 + 0.9 AS max_y FROM f_cities"),
    "g6_point": query(
        "SELECT tx_id, parcel_id, lon AS x, CASE WHEN lon IS NOT NULL THEN lat END AS y FROM f_transactions"
    ),
    "g7_to_geojson": query(f"SELECT city_id, {_GEOJSON} AS geojson FROM f_cities"),
    "g8_mercator_area": query(
        "SELECT city_id, "
        + half_up(
            "pow(6378137.0, 2) * radians(0.9) * (ln(tan(pi() / 4 + radians(y0 + 0.9) / 2)) - ln(tan(pi() / 4 + radians(y0) / 2))) / 1000000.0",
            4,
        )
        + " AS km2 FROM f_cities"
    ),
    "g9_intersects_box": query(
        "SELECT city_id, x0 <= 4 AND x0 + 0.9 >= 0 AND y0 <= 46 AND y0 + 0.9 >= 43 AS intersects FROM f_cities"
    ),
    "g10_within_box": query(
        """SELECT city_id, COUNT(*) FILTER (WHERE lon > 1 AND lon < 2 AND lat > 44 AND lat < 45) AS inside,
       COUNT(*) FILTER (WHERE NOT (lon > 1 AND lon < 2 AND lat > 44 AND lat < 45)) AS outside
FROM f_transactions GROUP BY city_id"""
    ),
    "g11_box_and_cell": query(
        """SELECT CAST(FLOOR(lon / 0.5) AS BIGINT) AS i, CAST(FLOOR(lat / 0.5) AS BIGINT) AS j, COUNT(*) AS n
FROM f_transactions WHERE lon IS NOT NULL GROUP BY 1, 2"""
    ),
    "g12_map_features": query(
        f"""SELECT level, area_id, agglomeration_id, name, price, max_price, min_price, satisfaction, word_cloud_url,
       sentiments_url, {_wkt()} AS geometry
FROM ({_features('city', _WORLD, 'COALESCE(p.parent_id, a.area_id)', "a.name <> 'Supplier#000000007'",
                 'LEFT JOIN f_districts p ON p.district_id = a.area_id')})"""
    ),
    "g13_transaction_features": query(
        f"""SELECT 'Feature' AS type, strftime(tx_date, '%Y-%m-%d') AS date, price, built_area, land_area, {_POINT} AS geometry
FROM ({_LATEST})"""
    ),
    "j5_with_satisfaction": query(
        """SELECT c.city_id AS area_id, c.name, q.satisfaction FROM f_cities c LEFT JOIN f_rated q ON q.city_id = c.city_id"""
    ),
    "j6_area_names": query(
        """SELECT r.department_id, r.cities, COALESCE(d.name, 'Département ' || r.department_id) AS name,
       COALESCE(d.region_id, '') AS region_id
FROM f_department_reviews r LEFT JOIN (SELECT * FROM f_departments WHERE region_id <> '0') d
  ON d.department_id = r.department_id"""
    ),
    "j13_areas_in_view": query(
        "SELECT city_id, name FROM f_cities WHERE x0 <= 2 AND x0 + 0.9 >= 1 AND y0 <= 45 AND y0 + 0.9 >= 44"
    ),
    "j13_areas_of_viewports": query(
        """SELECT v.view_id, c.city_id FROM f_viewports v JOIN f_cities c
  ON c.x0 <= v.sw_lon + 0.5 AND c.x0 + 0.9 >= v.sw_lon AND c.y0 <= v.sw_lat + 0.5 AND c.y0 + 0.9 >= v.sw_lat"""
    ),
    "j14_points_within": query("SELECT * FROM f_transactions WHERE lon > 0 AND lon < 4 AND lat > 43 AND lat < 46"),
    "p11_level_for_zoom": query(
        """SELECT view_id, zoom, CASE WHEN zoom <= 6 THEN 'region' WHEN zoom <= 9 THEN 'department' ELSE 'city' END AS level
FROM f_viewports"""
    ),
    "p12_region_view": _view("region", (41, -6, 52, 10)),
    "p12_department_view": _view("department", (43, 0, 46, 4)),
    "p12_city_view": _view("city", (44, 1, 45, 2)),
    "p12_fallback_view": query(
        f"""SELECT {_VIEW_COLUMNS} FROM ({_features('city', (41, -6, 52, 10))}) WHERE (SELECT COUNT(*) FROM f_cities) < 30
UNION ALL SELECT {_VIEW_COLUMNS} FROM ({_features('department', (41, -6, 52, 10))}) WHERE (SELECT COUNT(*) FROM f_cities) >= 30"""
    ),
    "s10_feature_collection": query(
        f"""SELECT '{{"type":"FeatureCollection","features":[' || COALESCE(string_agg({_FEATURE}, ',' ORDER BY area_id), '')
       || '],"metadata":{{"name":"Villes","min_price":' || CAST(COALESCE(MIN(price), 0.0) AS VARCHAR) || ',"max_price":'
       || CAST(COALESCE(MAX(price), 0.0) AS VARCHAR) || ',"show":true}}}}' AS document
FROM ({_features('city', (44, 1, 45, 2))})"""
    ),
    "s10_transaction_collection": query(
        f"""SELECT '{{"type":"FeatureCollection","features":[' || COALESCE(string_agg(sale, ',' ORDER BY sale), '') || ']}}' AS document
FROM (SELECT {_SALE} AS sale FROM ({_LATEST}))"""
    ),
    "k16_satisfaction_colours": query(
        f"""SELECT area_id, satisfaction, CASE WHEN satisfaction IS NOT NULL THEN {half_up(_HUE, 4)} END AS hue,
       CASE WHEN satisfaction IS NOT NULL THEN {half_up(_LIGHT, 4)} END AS lightness,
       CASE WHEN satisfaction IS NULL THEN '#888888' ELSE
         'hsl(' || CAST({half_up(_HUE, 4)} AS VARCHAR) || ', 100%, ' || CAST({half_up(_LIGHT, 4)} AS VARCHAR) || '%)' END AS colour
FROM (SELECT c.city_id AS area_id, q.satisfaction FROM f_cities c LEFT JOIN f_rated q ON q.city_id = c.city_id)"""
    ),
}
