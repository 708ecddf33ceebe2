"""SQL twins of the queries on sources, sinks, upserts, state and page extraction."""

from __future__ import annotations

from geoledger import constants as C
from oracle import texts
from oracle.base import CATEGORIES, SCORES, SENTIMENTS, fragment, query, share

_FIRST = """row_number() OVER (PARTITION BY tx_id, parcel_id ORDER BY tx_date NULLS FIRST, price NULLS FIRST,
  city_id NULLS FIRST, built_area NULLS FIRST, land_area NULLS FIRST, lon NULLS FIRST, lat NULLS FIRST)"""
_VALID = r"regexp_matches(url, '^https?://[^/]+/[^/]+-\d+/avis\.html$')"
_TX = "tx_id, parcel_id, tx_date, price, city_id, built_area, land_area, lon, lat"

_QUARTER = "'https://reviews.example/town-' || c.city_id || '/quartier-' || c.city_id || '/avis.html'"
fragment(
    "f_stored_pages",
    f"""SELECT city_id, url FROM f_city_docs
UNION ALL SELECT c.city_id, {_QUARTER} FROM f_city_docs c WHERE CAST(c.city_id AS BIGINT) % 8 = 0""",
)
fragment(
    "f_page_reviews",
    f"""SELECT r.review_id, CASE WHEN TRY_CAST(c.city_id AS BIGINT) % 8 = 0 AND CAST(r.review_id AS BIGINT) % 3 = 0
  THEN {_QUARTER} ELSE c.url END AS url FROM f_reviews r LEFT JOIN f_city_docs c ON c.city_id = r.city_id""",
)
fragment("f_first", f"SELECT * FROM (SELECT *, {_FIRST} rn FROM f_transactions) WHERE rn = 1")
fragment("f_early", f"SELECT * FROM (SELECT *, {_FIRST} rn FROM f_transactions WHERE tx_date < DATE '1996-01-01') WHERE rn = 1")
fragment("f_stored_urls", "SELECT url FROM f_city_docs WHERE review_count > 0")
fragment(
    "f_event_reviews",
    """SELECT CAST(event_id AS VARCHAR) review_id, CAST(user_id % 80 AS VARCHAR) city_id,
       1 + CAST(FLOOR(value) AS BIGINT) % 9 / 2.0 score,
       [event_type] || CASE event_id % 3 WHEN 0 THEN ['parc'] WHEN 1 THEN ['mairie', 'parc'] ELSE [] END words FROM events""",
)
_KIND = "CASE WHEN COALESCE(score, 0) >= 4 THEN 'positive' WHEN COALESCE(score, 0) <= 2 THEN 'negative' ELSE 'neutral' END"
fragment(
    "f_event_mood",
    f"""SELECT city_id, {', '.join(SENTIMENTS)}, {', '.join(f'{share(n, "reviews")} AS {n}_percent' for n in SENTIMENTS)}
FROM (SELECT city_id, COUNT(*) reviews, {', '.join(f"COUNT(*) FILTER (WHERE kind = '{n}') {n}" for n in SENTIMENTS)}
      FROM (SELECT city_id, {_KIND} kind FROM f_event_reviews) GROUP BY city_id)""",
)
_H1 = "regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')"
_NAME = f"""trim(regexp_replace(regexp_replace({_H1}, '&amp;?', '&', 'g'), '&quot;?', '"', 'g'))"""
_AREA = "{key}, name{parents}, MIN(x0) AS min_x, MIN(y0) AS min_y, MAX(x0 + 0.9) AS max_x, MAX(y0 + 0.9) AS max_y, CAST(COUNT(*) AS INTEGER) AS polygons"
_BLANKS = r"regexp_replace(description, '^\s+|\s+$', '', 'g')"

_CITY_URL = "'https://reviews.example/town-' || city_id || '/avis.html'"
_DEPARTMENT = """CASE WHEN length({code}) < 2 THEN '' WHEN starts_with({code}, '97') AND length({code}) >= 3
       THEN substr({code}, 1, 3) ELSE substr({code}, 1, 2) END"""
fragment("f_placed", "SELECT * FROM f_transactions WHERE lon IS NOT NULL AND lat IS NOT NULL")

ORACLE = {
    "s1_transaction_csv": query(
        """SELECT tx_id, tx_date, price, lpad(city_id, 5, '0') AS postal_code, city_id,
       'Town "' || city_id || '"' || chr(10) || 'with, comma' AS city_name, parcel_id, built_area, land_area, lat, lon
FROM f_transactions"""
    ),
    "s1_import_transactions": query(
        f"""SELECT {_TX.replace('price', 'CASE WHEN CAST(tx_id AS BIGINT) % 2 = 0 THEN price ELSE price + 1 END AS price')}
FROM (SELECT *, {_FIRST} AS place FROM f_placed) WHERE place = 1"""
    ),
    "s2_city_geojson": query(
        f"""SELECT {_AREA.format(key='city_id', parents=', department_id, region_id')} FROM f_cities GROUP BY ALL"""
    ),
    "s2_department_geojson": query(
        f"""SELECT {_AREA.format(key='department_id', parents=', region_id')} FROM (
SELECT DISTINCT d.department_id, d.name, d.region_id, c.x0, c.y0 FROM f_departments d
JOIN f_cities c ON c.department_id = d.department_id) GROUP BY ALL"""
    ),
    "s2_region_geojson": query(
        f"""SELECT {_AREA.format(key='region_id', parents='')} FROM (
SELECT DISTINCT r.region_id, r.name, c.x0, c.y0 FROM f_regions r
JOIN f_cities c ON c.region_id = r.region_id) GROUP BY ALL"""
    ),
    "s2_import_areas": query(
        f"""SELECT 'city' AS level, {_AREA.format(key='city_id AS id', parents='').replace('COUNT(*)', '1 + MAX(crossed::INTEGER)')}, BOOL_OR(crossed) AS repaired FROM (
SELECT city_id, CASE WHEN CAST(department_id AS INTEGER) < 15 THEN name ELSE 'renamed' END AS name, x0, y0,
  CAST(city_id AS BIGINT) % 7 = 0 AS crossed FROM f_cities) GROUP BY city_id, name
UNION ALL SELECT 'department', {_AREA.format(key='department_id', parents='')}, false FROM (
SELECT DISTINCT d.department_id, d.name, c.x0, c.y0 FROM f_departments d JOIN f_cities c ON c.department_id = d.department_id) GROUP BY ALL
UNION ALL SELECT 'region', {_AREA.format(key='region_id', parents='')}, false FROM (
SELECT DISTINCT r.region_id, r.name, c.x0, c.y0 FROM f_regions r JOIN f_cities c ON c.region_id = r.region_id) GROUP BY ALL"""
    ),
    "s3_write_table": query("SELECT CAST(year(tx_date) AS INTEGER) AS year, COUNT(*) AS n FROM f_first GROUP BY 1"),
    "s4_write_areas": query(
        """SELECT city_id, name, x0 AS min_x, y0 AS min_y, x0 + 0.9 AS max_x, y0 + 0.9 AS max_y FROM f_cities
WHERE region_id <> '4'"""
    ),
    "s5_find": query("SELECT city_id, name, review_count FROM f_city_docs WHERE review_count > 0"),
    "s6_find_one": query("SELECT city_id, name FROM f_city_docs WHERE review_count > 0 ORDER BY city_id LIMIT 1"),
    "s7_document_round_trip": query(
        """SELECT w.city_id, w.word, w.weight, w.rank FROM f_city_words w
JOIN f_city_word_docs d ON d.city_id = w.city_id"""
    ),
    "s8_csv_export": query(
        """SELECT w.word, CAST(SUM(w.weight) AS BIGINT) AS weight FROM f_city_words w
JOIN f_city_word_docs d ON d.city_id = w.city_id GROUP BY w.word ORDER BY weight DESC, word LIMIT 50"""
    ),
    "u1_dedup_insert": query(
        f"""SELECT {_TX.replace('price', '-1.0::DOUBLE AS price')} FROM f_early
UNION ALL SELECT {_TX} FROM f_first f WHERE NOT EXISTS (
  SELECT 1 FROM f_early e WHERE e.tx_id = f.tx_id AND e.parcel_id = f.parcel_id)"""
    ),
    "u2_upsert_geometry": query(
        """SELECT city_id, CASE WHEN d < 15 THEN name ELSE 'renamed' END AS name, department_id,
       x0 + CASE WHEN d >= 5 THEN 0.5 ELSE 0 END AS min_x, y0 AS min_y
FROM (SELECT *, CAST(department_id AS INTEGER) d FROM f_cities)"""
    ),
    "u3_upsert_stats": query(
        """SELECT city_id, region_id, transactions, CASE WHEN region_id = '1' THEN price_mean ELSE 0.0 END AS price_mean
FROM f_city_stats"""
    ),
    "u4_upsert_documents": query(
        """SELECT COALESCE(d.city_id, r.city_id) AS city_id, d.name, CASE WHEN r.n IS NOT NULL THEN 'unprocessed' ELSE d.status END AS status,
       r.n AS reviews
FROM f_city_docs d FULL JOIN (SELECT city_id, COUNT(*) n FROM f_reviews GROUP BY city_id) r ON r.city_id = d.city_id"""
    ),
    "u5_unprocessed": query("SELECT city_id, name, status FROM f_city_docs WHERE status IS NULL OR status = 'unprocessed'"),
    "u6_mark_processed": query(
        """SELECT city_id, 'processed' AS status, CASE WHEN status = 'processed' THEN strftime(processed_at, '%Y-%m-%d %H:%M:%S')
       ELSE '2024-06-01 12:00:00' END AS processed_at FROM f_city_docs"""
    ),
    "u7_purge_counts": query(
        f"""SELECT 'cities' AS item, COUNT(*) AS rows FROM f_stored_pages WHERE NOT {_VALID}
UNION ALL SELECT 'reviews', COUNT(*) FROM f_page_reviews WHERE NOT {_VALID}"""
    ),
    "u7_purge_rest": query(
        f"""SELECT 'city' AS kind, url AS id FROM f_stored_pages WHERE {_VALID}
UNION ALL SELECT 'review', review_id FROM f_page_reviews WHERE url IS NULL OR {_VALID}"""
    ),
    "u8_new_urls": query("SELECT url FROM f_urls EXCEPT SELECT url FROM f_stored_urls"),
    "u8_known_urls": query("SELECT url FROM f_urls INTERSECT SELECT url FROM f_stored_urls"),
    "u9_incremental_words": query(
        f"""SELECT m.city_id, c.name AS city_name, {', '.join('m.' + n for n in [*SENTIMENTS, *[f'{n}_percent' for n in SENTIMENTS]])}, w.word, w.weight
FROM f_event_mood m JOIN f_city_docs c ON c.city_id = m.city_id
JOIN (SELECT city_id, word, COUNT(*) weight FROM (SELECT city_id, unnest(words) word FROM f_event_reviews) GROUP BY 1, 2) w
  ON w.city_id = m.city_id"""
    ),
    "u10_requeue_stale": query(
        """SELECT city_id, CASE WHEN processed_at < TIMESTAMP '2024-01-20 00:00:00' THEN 'unprocessed' ELSE status END AS status
FROM f_city_docs"""
    ),
    "x2_url_difference": query(f"SELECT DISTINCT url FROM f_urls WHERE NOT {_VALID}"),
    "x3_url_intersection": query(f"SELECT DISTINCT url FROM f_urls WHERE {_VALID}"),
    "p16_valid_urls": query(f"SELECT id, url FROM f_urls WHERE {_VALID}"),
    "p17_classify_urls": query(
        f"""SELECT class, COUNT(*) AS urls, MIN(url) AS example FROM (
SELECT url, CASE WHEN {_VALID} THEN 'valid' WHEN contains(url, '/quartier-') THEN 'quarter'
  WHEN contains(lower(url), 'arrondissement') THEN 'district' ELSE 'other' END AS class FROM f_urls) GROUP BY class"""
    ),
    "p18_city_code": query(r"SELECT id, regexp_extract(url, '/[^/]+-(\d+)/avis\.html', 1) AS code FROM f_urls"),
    "p19_department_of": query(
        f"""SELECT code, {_DEPARTMENT.format(code='code')} AS department
FROM (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) code FROM orders)"""
    ),
    "p20_heading_fields": query(
        f"""SELECT url, {_NAME} AS name, '' AS postal_code FROM pages
UNION ALL SELECT {_CITY_URL}, name || ' ' || postal_code, postal_code FROM f_city_docs"""
    ),
    "p21_city_rows": query(
        f"""SELECT url, '' AS city_id, {_NAME} AS name, '' AS postal_code, '' AS department_id,
       {', '.join(f'0.0::DOUBLE AS {s}' for s in SCORES)}, 0::BIGINT AS review_count, 'unprocessed' AS status FROM pages
UNION ALL SELECT {_CITY_URL}, city_id, name || ' ' || postal_code, postal_code, {_DEPARTMENT.format(code='city_id')},
       {', '.join(SCORES)}, review_count, 'unprocessed' FROM f_city_docs"""
    ),
    "p21_review_rows": query(
        rf"""SELECT review_id, CASE WHEN city_id = 'unknown' THEN '' ELSE city_id END AS city_id,
       'https://reviews.example/town-' || city_id || '/avis.html' AS url, '{C.ANONYMOUS}' AS author,
       DATE '2024-02-03' AS review_day, COALESCE(score, 0.0) AS score, {', '.join(CATEGORIES)},
       {_BLANKS} AS description, 3::BIGINT AS thumbs_up, 0::BIGINT AS thumbs_down FROM f_reviews"""
    ),
    "p22_score_and_count_text": query("SELECT city_id, mean AS score, review_count AS reviews FROM f_city_docs"),
    "p23_pivot_scores": query(f"SELECT city_id, {', '.join(CATEGORIES)} FROM f_city_docs"),
    "p24_truncate_text": query(
        """SELECT review_id, CASE WHEN length(description) > 100 THEN substr(description, 1, 97) || '...' ELSE description END AS excerpt
FROM f_reviews"""
    ),
    "p25_cap_cities": query("SELECT city_id, name FROM f_cities ORDER BY city_id LIMIT 10"),
}
