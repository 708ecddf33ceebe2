"""SQL twins of the queries on transactions and property statistics."""

from __future__ import annotations

from oracle.base import fragment, half_up, query

fragment(
    "f_priced_cities",
    """SELECT c.city_id area_id, c.name, s.transactions, s.price_min min_price, s.price_max max_price, s.price_m2_mean price
FROM f_cities c LEFT JOIN f_city_stats s ON s.city_id = c.city_id""",
)
fragment(
    "f_bounds",
    """SELECT COALESCE(MIN(price), 0.0) min_price, COALESCE(MAX(price), 0.0) max_price
FROM f_priced_cities WHERE price >= 500""",
)
fragment("f_districts", "SELECT * FROM (VALUES ('90','91'),('90','92'),('90','93'),('80','81'),('80','82')) t(parent_id, district_id)")
fragment(
    "f_listed",
    """SELECT 'city' AS level, c.city_id area_id, c.name, CASE WHEN s.price_m2_mean >= 500 THEN s.price_m2_mean END price
FROM f_cities c LEFT JOIN f_city_stats s ON s.city_id = c.city_id WHERE NOT starts_with(c.name, 'Supplier#00000001')
UNION ALL SELECT 'department', d.department_id, d.name, CASE WHEN s.price_m2_mean >= 500 THEN s.price_m2_mean END
FROM (SELECT DISTINCT d.department_id, d.name FROM f_departments d JOIN f_cities c ON c.department_id = d.department_id) d
LEFT JOIN f_department_stats s ON s.department_id = d.department_id
UNION ALL SELECT 'region', r.region_id, r.name, CASE WHEN s.price_m2_mean >= 500 THEN s.price_m2_mean END
FROM (SELECT DISTINCT r.region_id, r.name FROM f_regions r JOIN f_cities c ON c.region_id = r.region_id) r
LEFT JOIN f_region_stats s ON s.region_id = r.region_id""",
)
fragment(
    "f_drifted",
    """SELECT department_id, name, region_id, transactions - CASE WHEN region_id = '0' THEN 1 ELSE 0 END transactions
FROM f_department_stats""",
)
fragment("f_usual", "SELECT built_mean, land_mean FROM f_city_stats WHERE built_mean < 1000 AND land_mean < 10000")


def _histogram(measure: str) -> str:
    return f"""SELECT '{measure}' AS measure, b.bucket, {half_up('lo + (hi - lo) / 50 * (b.bucket - 1)', 4)} AS low,
       {half_up('lo + (hi - lo) / 50 * b.bucket', 4)} AS high, COUNT(v.v) AS n
FROM (SELECT CAST(range AS INTEGER) bucket FROM range(1, 51)) b
CROSS JOIN (SELECT MIN({measure}_mean) lo, MAX({measure}_mean) hi FROM f_usual) r
LEFT JOIN (SELECT {measure}_mean v, CAST(LEAST(FLOOR(({measure}_mean - lo) / ((hi - lo) / 50)), 49) AS INTEGER) + 1 bucket
           FROM f_usual CROSS JOIN (SELECT MIN({measure}_mean) lo, MAX({measure}_mean) hi FROM f_usual)) v
  ON v.bucket = b.bucket
GROUP BY b.bucket, lo, hi"""


_RATIO = "GREATEST(0.0, LEAST(1.0, (price - min_price) / NULLIF(max_price - min_price, 0)))"

ORACLE = {
    "a1_city_stats": query("SELECT * FROM f_city_stats"),
    "a2_department_stats": query("SELECT * FROM f_department_stats"),
    "a3_region_stats": query("SELECT * FROM f_region_stats"),
    "a4_property_rollup": query("SELECT * FROM f_region_stats"),
    "a5_legend_bounds": query("SELECT * FROM f_bounds"),
    "a6_area_listing": query(
        """SELECT l.level, CASE l.level WHEN 'city' THEN 'Villes' WHEN 'department' THEN 'Départements' ELSE 'Régions' END title,
       l.area_id, l.name, l.price, b.min_price, b.max_price
FROM f_listed l JOIN (SELECT level, COALESCE(MIN(price), 0.0) min_price, COALESCE(MAX(price), 0.0) max_price
                      FROM f_listed GROUP BY level) b ON b.level = l.level"""
    ),
    "j4_areas_with_stats": query("SELECT *, 'city' AS level FROM f_priced_cities"),
    "p1_drop_incomplete": query(
        "SELECT * FROM f_transactions WHERE lat IS NOT NULL AND lon IS NOT NULL AND tx_id IS NOT NULL AND parcel_id IS NOT NULL"
    ),
    "p2_conform_transactions": query(
        """SELECT tx_id, tx_date, price, lpad(city_id, 5, '0') postal_code, city_id, 'Supplier ' || city_id city_name,
       parcel_id, built_area, land_area, lat, lon FROM f_transactions"""
    ),
    "p3_positive_sales": query("SELECT * FROM f_sales"),
    "p4_mask_low_price": query(
        "SELECT city_id, CASE WHEN price_m2_mean >= 500 THEN price_m2_mean END AS price FROM f_city_stats"
    ),
    "p5_visible_transactions": query("SELECT * FROM f_transactions WHERE price >= 500"),
    "p6_transactions_of_cities": query("SELECT * FROM f_transactions WHERE city_id IN ('3', '17', '42')"),
    "p7_agglomeration_transactions": query(
        """SELECT * FROM f_transactions WHERE city_id IN (
SELECT COALESCE(d.district_id, c.city_id) FROM f_cities c LEFT JOIN f_districts d ON d.parent_id = c.city_id
WHERE c.department_id IN ('3', '7', '11', '20'))"""
    ),
    "p8_agglomeration_ids": query(
        """SELECT c.city_id, c.name, COALESCE(d.parent_id, c.city_id) AS agglomeration_id
FROM f_cities c LEFT JOIN f_districts d ON d.district_id = c.city_id"""
    ),
    "p9_exclude_parents": query(
        "SELECT city_id, name FROM f_cities WHERE name NOT IN ('Supplier#000000007', 'Supplier#000000011')"
    ),
    "p10_exclude_districts": query(
        """SELECT city_id, name FROM f_cities
WHERE NOT starts_with(name, 'Supplier#00000001') AND NOT starts_with(name, 'Supplier#00000003')"""
    ),
    "p13_date_text": query(
        """SELECT tx_id, parcel_id, strftime(tx_date, '%Y-%m-%d') AS date, strftime(tx_date, '%Y-%m-%d') AS date_from_text
FROM f_transactions"""
    ),
    "p14_transaction_view": query(
        """SELECT strftime(tx_date, '%Y-%m-%d') AS date, price, built_area AS building_area, land_area
FROM f_transactions WHERE city_id = '5' AND price >= 500 ORDER BY 1, 2, 3, 4"""
    ),
    "p15_price_table": query("SELECT area_id, name, price FROM f_priced_cities"),
    "j17_points_in_areas": query(
        f"""SELECT c.city_id AS area_id, COUNT(*) AS transactions, {half_up('AVG(t.price)', 2)} AS price_mean,
       {half_up('AVG(t.built_area)', 2)} AS built_area_mean, {half_up('AVG(t.land_area)', 2)} AS land_area_mean
FROM f_cities c JOIN f_transactions t
  ON t.lon > c.x0 AND t.lon < c.x0 + 0.9 AND t.lat > c.y0 AND t.lat < c.y0 + 0.9
GROUP BY c.city_id"""
    ),
    "k1_recent_transactions": query(
        """SELECT * FROM f_transactions WHERE price >= 500 AND lon > 0 AND lon < 4 AND lat > 43 AND lat < 46
ORDER BY tx_date DESC, tx_id, parcel_id, price, built_area NULLS FIRST, land_area NULLS FIRST, lon, lat LIMIT 750"""
    ),
    "k4_top_cities_by_sales": query(
        """SELECT city_id, name, transactions, price_mean, price_m2_mean FROM f_city_stats
ORDER BY transactions DESC, city_id LIMIT 10"""
    ),
    "k5_top_cities_by_price": query(
        """SELECT city_id, name, transactions, price_mean, price_m2_mean FROM f_city_stats
WHERE price_mean IS NOT NULL ORDER BY price_mean DESC, city_id LIMIT 10"""
    ),
    "k6_top_departments": query(
        """SELECT s.department_id, s.transactions, s.price_mean, s.cities, d.name
FROM f_department_stats s JOIN f_departments d ON d.department_id = s.department_id
WHERE s.transactions > 0 ORDER BY s.transactions DESC, s.department_id LIMIT 10"""
    ),
    "k7_regions_by_price": query(
        f"""SELECT region_id, name, price_mean, transactions,
       {half_up('CAST(transactions AS DOUBLE) / MAX(transactions) OVER ()', 4)} AS volume_share
FROM f_region_stats WHERE price_mean IS NOT NULL ORDER BY price_mean DESC, region_id"""
    ),
    "k10_volume_outliers": query(
        """SELECT department_id, name, price_mean, transactions,
       CASE WHEN price_mean > quantile_cont(price_mean, 0.9) OVER ()
              OR transactions > quantile_cont(CAST(transactions AS DOUBLE), 0.9) OVER () THEN name END AS label
FROM (SELECT * FROM f_department_stats WHERE price_mean IS NOT NULL AND transactions > 10
      ORDER BY transactions DESC, department_id LIMIT 50)"""
    ),
    "k13_area_histogram": query(_histogram("built") + " UNION ALL " + _histogram("land")),
    "k16_choropleth": query(
        f"""SELECT area_id, price, CASE WHEN price IS NOT NULL THEN {half_up(f'(1 - {_RATIO}) * 180', 4)} END AS hue,
       CASE WHEN price IS NOT NULL THEN {half_up(f'20 + {_RATIO} * 40', 4)} END AS lightness
FROM (SELECT area_id, CASE WHEN price >= 500 THEN price END price, min_price AS x, max_price AS y FROM f_priced_cities)
CROSS JOIN f_bounds"""
    ),
    "k17_legend_ticks": query(
        """SELECT CAST(FLOOR(min_price + 0.5) AS BIGINT) AS low, CAST(FLOOR((min_price + max_price) / 2 + 0.5) AS BIGINT) AS middle,
       CAST(FLOOR(max_price + 0.5) AS BIGINT) AS high FROM f_bounds"""
    ),
    "v6_rollup_mismatches": query(
        """SELECT 'department' AS level, d.department_id AS area_id, d.name, d.transactions AS total,
       CAST(c.n AS BIGINT) AS children_total
FROM f_drifted d LEFT JOIN (SELECT department_id, SUM(transactions) n FROM f_city_stats GROUP BY department_id) c
  ON c.department_id = d.department_id WHERE abs(d.transactions - c.n) > 0
UNION ALL
SELECT 'region', r.region_id, r.name, r.transactions, CAST(c.n AS BIGINT)
FROM f_region_stats r LEFT JOIN (SELECT region_id, SUM(transactions) n FROM f_drifted GROUP BY region_id) c
  ON c.region_id = r.region_id WHERE abs(r.transactions - c.n) > 0"""
    ),
    "v7_price_sanity": query(
        f"""SELECT COUNT(*) AS cities, COUNT(*) FILTER (WHERE price_mean < 0) AS negative_prices,
       COUNT(*) FILTER (WHERE price_mean > 50000) AS extreme_prices, MIN(price_mean) AS min_price,
       MAX(price_mean) AS max_price, {half_up('AVG(price_mean)', 2)} AS mean_price
FROM f_city_stats WHERE price_mean IS NOT NULL"""
    ),
    "v13_level_summary": query(
        " UNION ALL ".join(
            f"""SELECT '{level}' AS level, COUNT(*) AS areas, COALESCE({half_up('AVG(transactions)', 2)}, 0.0) AS mean_transactions,
       COALESCE(MIN(transactions), 0) AS min_transactions, COALESCE(MAX(transactions), 0) AS max_transactions,
       COALESCE({half_up('AVG(price_mean)', 2)}, 0.0) AS mean_price, COALESCE(MIN(price_mean), 0.0) AS min_price,
       COALESCE(MAX(price_mean), 0.0) AS max_price FROM f_{level}_stats WHERE transactions > 0"""
            for level in ("city", "department", "region")
        )
    ),
}
