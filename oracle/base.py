"""Named SQL fragments and the assembly of a query from those it mentions."""

from __future__ import annotations

import re

FRAGMENTS: dict[str, str] = {}


def fragment(name: str, sql: str) -> None:
    FRAGMENTS[name] = sql


def query(body: str) -> str:
    """``body`` preceded by every fragment it uses, directly or through another fragment."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bf_\w+", sql)):
            if name not in ordered:
                visit(FRAGMENTS[name])
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({FRAGMENTS[name]})" for name in ordered) + "\n" + body


def half_up(expr: str, digits: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(30,6)), {digits}) AS DOUBLE)"


def share(part: str, whole: str, digits: int = 1) -> str:
    return f"COALESCE({half_up(f'CAST({part} AS DOUBLE) / NULLIF({whole}, 0) * 100', digits)}, 0.0)"


SCORES = ("mean", "safety", "education", "sport_leisure", "environment", "practical_life")
CATEGORIES = SCORES[1:]
SENTIMENTS = ("positive", "neutral", "negative")

# --- bindings -----------------------------------------------------------------------------------
fragment("f_regions", "SELECT CAST(r_regionkey AS VARCHAR) region_id, r_name name FROM region")
fragment(
    "f_departments",
    "SELECT CAST(n_nationkey AS VARCHAR) department_id, n_name name, CAST(n_regionkey AS VARCHAR) region_id FROM nation",
)
fragment(
    "f_cities",
    """SELECT CAST(s_suppkey AS VARCHAR) city_id, s_name name, CAST(s_nationkey AS VARCHAR) department_id,
       CAST(n_regionkey AS VARCHAR) region_id,
       CAST(-5 + s_suppkey % 14 AS DOUBLE) x0,
       CAST(42 + CAST(FLOOR(s_suppkey / 14.0) AS BIGINT) % 9 AS DOUBLE) y0
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
fragment(
    "f_transactions",
    """SELECT CAST(l_orderkey AS VARCHAR) tx_id, CAST(l_linenumber AS VARCHAR) parcel_id,
       CAST(l_shipdate AS DATE) tx_date,
       CASE WHEN l_orderkey % 41 = 0 THEN 0 WHEN l_orderkey % 43 = 0 THEN l_discount * 1000
            ELSE l_extendedprice END price,
       CAST(l_suppkey AS VARCHAR) city_id,
       CASE WHEN l_discount = 0 THEN 0 WHEN l_suppkey % 9 = 0 THEN l_quantity * 100
            ELSE l_quantity END built_area,
       CASE WHEN l_tax > 0 THEN l_quantity * 10 END land_area,
       CASE WHEN l_orderkey % 47 <> 0 THEN -5 + CAST(l_partkey % 1400 AS DOUBLE) / 100 END lon,
       42 + CAST(l_orderkey % 900 AS DOUBLE) / 100 lat
FROM lineitem""",
)
fragment(
    "f_reviews",
    """SELECT CAST(doc_id AS VARCHAR) review_id,
       CASE WHEN doc_id % 97 = 0 THEN 'unknown' ELSE CAST(doc_id % 80 AS VARCHAR) END city_id,
       CASE WHEN doc_id % 53 = 0 THEN NULL ELSE CAST(n_chars % 9 + 2 AS DOUBLE) / 2 END score,
       CAST((n_chars + 1) % 9 + 2 AS DOUBLE) / 2 safety,
       CAST((n_chars + 2) % 9 + 2 AS DOUBLE) / 2 education,
       CAST((n_chars + 3) % 9 + 2 AS DOUBLE) / 2 sport_leisure,
       CAST((n_chars + 4) % 9 + 2 AS DOUBLE) / 2 environment,
       CAST((n_chars + 5) % 9 + 2 AS DOUBLE) / 2 practical_life,
       text description
FROM documents""",
)
fragment(
    "f_urls",
    """SELECT s_suppkey id, 'https://reviews.example/' || CASE s_suppkey % 4
         WHEN 0 THEN 'town-' || CAST(s_suppkey AS VARCHAR)
         WHEN 1 THEN 'town-' || CAST(s_suppkey AS VARCHAR) || '/quartier-' || CAST(s_suppkey AS VARCHAR)
         WHEN 2 THEN 'arrondissement/' || CAST(s_suppkey AS VARCHAR)
         ELSE 'about' END || '/avis.html' url
FROM supplier""",
)
fragment(
    "f_city_docs",
    f"""SELECT c.city_id, c.name, lpad(c.city_id, 5, '0') postal_code, c.city_id insee_code, c.department_id, u.url,
       COALESCE({half_up('r.mean', 1)}, 0.0)
         + CASE WHEN CAST(c.city_id AS BIGINT) % 10 = 0 AND r.n IS NOT NULL THEN 1.0 ELSE 0.0 END AS mean,
       {', '.join(f"COALESCE({half_up('r.' + n, 1)}, 0.0) AS {n}" for n in CATEGORIES)},
       COALESCE(r.n, 0) review_count,
       CASE CAST(c.city_id AS BIGINT) % 3 WHEN 0 THEN 'processed' WHEN 1 THEN 'unprocessed' END status,
       CASE WHEN CAST(c.city_id AS BIGINT) % 3 = 0
            THEN CAST(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(CAST(c.city_id AS BIGINT) % 60 AS INTEGER)) AS TIMESTAMP)
            END processed_at
FROM f_cities c JOIN f_urls u ON CAST(u.id AS VARCHAR) = c.city_id
LEFT JOIN (SELECT city_id, COUNT(*) n, AVG(COALESCE(score, 0)) mean,
           {', '.join(f'AVG({n}) {n}' for n in CATEGORIES)} FROM f_reviews GROUP BY city_id) r
  ON r.city_id = c.city_id""",
)

# --- property statistics ------------------------------------------------------------------------
_KM2 = (
    "(pow(6378137.0, 2) * radians(0.9) * (ln(tan(pi() / 4 + radians(y0 + 0.9) / 2))"
    " - ln(tan(pi() / 4 + radians(y0) / 2))) / 1000000.0)"
)
_MEASURES = (
    "price_mean", "price_median", "price_min", "price_max", "price_m2_mean", "price_m2_median",
    "built_mean", "built_median", "land_mean", "land_median",
)
_ROUNDED = (
    ", ".join(f"{half_up(m, 2)} AS {m}" for m in _MEASURES)
    + f", first_date, last_date, {half_up('density_per_mercator_km2', 4)} AS density_per_mercator_km2"
)
fragment(
    "f_sales",
    """SELECT city_id, tx_id, tx_date, price, CASE WHEN built_area > 0 THEN price / built_area END price_m2,
       CASE WHEN built_area > 0 THEN built_area END built, CASE WHEN land_area > 0 THEN land_area END land
FROM f_transactions WHERE price > 0""",
)
fragment(
    "f_city_stats",
    f"""SELECT city_id, name, department_id, region_id, transactions, transactions_built, transactions_land, {_ROUNDED}
FROM (
  SELECT c.city_id, c.name, c.department_id, c.region_id, COUNT(tx_id) transactions, COUNT(built) transactions_built,
         COUNT(land) transactions_land, AVG(price) price_mean, median(price) price_median, MIN(price) price_min,
         MAX(price) price_max, AVG(price_m2) price_m2_mean, median(price_m2) price_m2_median, AVG(built) built_mean,
         median(built) built_median, AVG(land) land_mean, median(land) land_median, MIN(tx_date) first_date,
         MAX(tx_date) last_date, COUNT(tx_id) / NULLIF({_KM2}, 0) density_per_mercator_km2
  FROM f_cities c JOIN f_sales s ON s.city_id = c.city_id
  GROUP BY c.city_id, c.name, c.department_id, c.region_id, c.y0)""",
)


def _guarded(mean: str, n: str) -> str:
    return (
        f"SUM(CASE WHEN s.{mean} IS NOT NULL AND s.{n} > 0 THEN s.{mean} * s.{n} END)"
        f" / NULLIF(SUM(CASE WHEN s.{n} > 0 THEN s.{n} END), 0) AS {mean}"
    )


_ROLLUP = f"""CAST(SUM(s.transactions) AS BIGINT) transactions, CAST(SUM(s.transactions_built) AS BIGINT) transactions_built,
  CAST(SUM(s.transactions_land) AS BIGINT) transactions_land,
  SUM(s.price_mean * s.transactions) / NULLIF(SUM(s.transactions), 0) price_mean, median(s.price_median) price_median,
  MIN(s.price_min) price_min, MAX(s.price_max) price_max,
  {_guarded('price_m2_mean', 'transactions_built')}, median(s.price_m2_median) price_m2_median,
  {_guarded('built_mean', 'transactions_built')}, median(s.built_median) built_median,
  {_guarded('land_mean', 'transactions_land')}, median(s.land_median) land_median,
  MIN(s.first_date) first_date, MAX(s.last_date) last_date,
  SUM(s.density_per_mercator_km2 * s.transactions) / NULLIF(SUM(s.transactions), 0) density_per_mercator_km2"""
fragment(
    "f_department_stats",
    f"""SELECT department_id, name, region_id, cities, transactions, transactions_built, transactions_land, {_ROUNDED}
FROM (SELECT d.department_id, d.name, d.region_id, COUNT(s.city_id) cities, {_ROLLUP}
      FROM f_departments d JOIN f_city_stats s ON s.department_id = d.department_id WHERE s.transactions > 0
      GROUP BY d.department_id, d.name, d.region_id)""",
)
fragment(
    "f_region_stats",
    f"""SELECT region_id, name, departments, cities, transactions, transactions_built, transactions_land, {_ROUNDED}
FROM (SELECT r.region_id, r.name, COUNT(s.department_id) departments, CAST(SUM(s.cities) AS BIGINT) cities, {_ROLLUP}
      FROM f_regions r JOIN f_department_stats s ON s.region_id = r.region_id WHERE s.transactions > 0
      GROUP BY r.region_id, r.name)""",
)
