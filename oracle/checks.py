"""SQL twins of the data-quality queries."""

from __future__ import annotations

from geoledger import constants as C
from oracle import properties, texts  # noqa: F401  (their fragments are used here)
from oracle.base import CATEGORIES, SENTIMENTS, fragment, half_up, query, share

_MODEL = {
    "regions": ("f_regions", {"region_id": "string", "name": "string"}),
    "departments": ("f_departments", {"department_id": "string", "name": "string", "region_id": "string"}),
    "transactions": (
        "f_transactions",
        {
            "tx_id": "string", "parcel_id": "string", "tx_date": "date", "price": "double", "city_id": "string",
            "built_area": "double", "land_area": "double", "lon": "double", "lat": "double",
        },
    ),
}
_COUNTERS = ("transactions", "transactions_built", "transactions_land")


def _count(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS "table", COUNT(*) AS rows FROM {source}"""


def _profile(name: str, source: str, columns: dict[str, str]) -> str:
    rows = ", ".join(f"('{c}', '{t}')" for c, t in columns.items())
    return f"""SELECT '{name}' AS "table", c."column", c.type, (SELECT COUNT(*) FROM {source}) AS rows
FROM (VALUES {rows}) c("column", type)"""


def _check(name: str, condition: str) -> str:
    return f"""SELECT '{name}' AS "check", {condition} AS ok"""


_UNEVEN = "positive > 0 AND round_even(positive_percent + neutral_percent + negative_percent, 0) <> 100"
_FIELDS = ["name", "postal_code", "insee_code", "city_id", "department_id", "url"]


def _totals(lower: str, upper: str, name: str) -> str:
    def total(level: str) -> str:
        if level == "city":
            value = "SUM(review_count)" if name == "reviews" else "COUNT(*)"
            return f"(SELECT CAST({value} AS BIGINT) FROM f_city_docs)"
        return f"(SELECT CAST(SUM({name}) AS BIGINT) FROM f_{level}_docs)"

    return f"""SELECT '{name}_{lower}_{upper}' AS "check", {total(lower)} AS lower, {total(upper)} AS upper,
       {total(lower)} = {total(upper)} AS ok"""


fragment(
    "f_gaps",
    f"""SELECT r.city_id, c.name, r.n AS reviews, {half_up('r.computed', 4)} AS computed, c.mean AS stored,
       {half_up('abs(r.computed - c.mean)', 4)} AS difference
FROM (SELECT city_id, AVG(score) computed, COUNT(*) n FROM f_reviews GROUP BY city_id) r
LEFT JOIN f_city_docs c ON c.city_id = r.city_id WHERE abs(r.computed - c.mean) > 0.5""",
)
fragment(
    "f_sanity",
    f"""SELECT COUNT(*) AS cities, COUNT(*) FILTER (WHERE price_mean < 0) AS negative_prices,
       COUNT(*) FILTER (WHERE price_mean > 50000) AS extreme_prices, MIN(price_mean) AS min_price,
       MAX(price_mean) AS max_price, {half_up('AVG(price_mean)', 2)} AS mean_price
FROM f_city_stats WHERE price_mean IS NOT NULL""",
)

ORACLE = {
    "s11_profile": query(" UNION ALL ".join(_profile(n, *spec) for n, spec in _MODEL.items())),
    "s11_profile_by_name": query(
        " UNION ALL ".join(
            _profile(f"{level}_stats", f"f_{level}_stats", {c: "bigint" for c in _COUNTERS})
            for level in ("city", "department", "region")
        )
    ),
    "s12_required_inputs": query(
        " UNION ALL ".join(
            f"""SELECT '{n}' AS "table", COUNT(*) AS rows, COUNT(*) > 0 AS present FROM f_{n}"""
            for n in ("departments", "regions", "transactions")
        )
    ),
    "x1_table_counts": query(
        " UNION ALL ".join(
            _count(n, f"f_{n}") for n in ("cities", "departments", "regions", "transactions", "city_stats")
        )
    ),
    "j8_orphan_city_ids": query("SELECT DISTINCT city_id FROM f_reviews WHERE city_id NOT IN (SELECT city_id FROM f_cities)"),
    "j9_cities_without_reviews": query(
        "SELECT city_id, name FROM f_cities WHERE city_id NOT IN (SELECT city_id FROM f_reviews)"
    ),
    "j9_cities_counted_empty": query("SELECT city_id, name FROM f_city_docs WHERE review_count = 0"),
    "v1_review_totals": query(
        f"""SELECT CAST(c.n AS BIGINT) AS cities, CAST(r.n AS BIGINT) AS reviews, {half_up('CAST(r.n AS DOUBLE) / c.n', 2)} AS reviews_per_city
FROM (SELECT COUNT(*) n FROM f_cities) c CROSS JOIN (SELECT COUNT(*) n FROM f_reviews) r"""
    ),
    "v2_reviews_per_city": query(
        f"""SELECT MIN(n) AS minimum, MAX(n) AS maximum, {half_up('AVG(n)', 2)} AS mean
FROM (SELECT COUNT(*) n FROM f_reviews GROUP BY city_id)"""
    ),
    "v3_score_gaps": query("SELECT * FROM f_gaps"),
    "v4_missing_fields": query(
        " UNION ALL ".join(
            [
                f"""SELECT 'cities' AS "table", '{f}' AS field, COUNT(*) FILTER (WHERE {f} IS NULL) AS missing FROM f_city_docs"""
                for f in [*_FIELDS, "review_count"]
            ]
            + ["""SELECT 'cities', 'scores', 0"""]
            + [f"SELECT 'cities', 'scores.{s}', COUNT(*) FILTER (WHERE {s} IS NULL) FROM f_city_docs" for s in C.SCORES]
            + [
                f"SELECT 'reviews', '{f}', COUNT(*) FILTER (WHERE {f} IS NULL) FROM f_reviews"
                for f in ("city_id", "review_id", "score", "safety", "description")
            ]
            + [f"SELECT 'reviews', '{f}', COUNT(*) FROM f_reviews" for f in ("author", "review_date", "url")]
        )
    ),
    "v4_empty_descriptions": query("SELECT COUNT(*) FILTER (WHERE description = '') AS empty_descriptions FROM f_reviews"),
    "v5_score_distribution": query(
        f"""SELECT score, n AS reviews, {share('n', '(SUM(n) OVER ())', 2)} AS share
FROM (SELECT CAST(round_even(score, 0) AS INTEGER) score, COUNT(*) n FROM f_reviews GROUP BY 1)"""
    ),
    "v5_category_means": query(
        " UNION ALL ".join(
            f"SELECT '{c}' AS category, {half_up(f'AVG(COALESCE({c}, 0))', 2)} AS mean FROM f_reviews" for c in CATEGORIES
        )
    ),
    "v8_document_checks": query(
        " UNION ALL ".join(
            [
                _check(f"{level}_count_match", f"(SELECT COUNT(*) FROM f_{level}_docs) = (SELECT COUNT(*) FROM f_{level}s)")
                for level in ("department", "region")
            ]
            + [_check(f"{level}_structure", f"(SELECT COUNT(*) > 0 FROM f_{level}_docs)") for level in ("department", "region")]
            + [
                _check(
                    "department_region_match",
                    """(SELECT COUNT(*) = 0 FROM f_department_docs d JOIN f_departments r
                ON r.department_id = d.department_id AND r.region_id <> d.region_id)""",
                ),
                _check(
                    "region_list_match",
                    """(SELECT COUNT(*) = 0 FROM f_region_docs r WHERE r.departments <>
                (SELECT COUNT(*) FROM f_department_docs d WHERE d.region_id = r.region_id))""",
                ),
            ]
        )
    ),
    "v9_count_ranges": query(
        """SELECT 'departments' AS "table", COUNT(*) AS rows, 90 AS low, 110 AS high, COUNT(*) BETWEEN 90 AND 110 AS ok FROM f_department_docs
UNION ALL SELECT 'regions', COUNT(*), 12, 18, COUNT(*) BETWEEN 12 AND 18 FROM f_region_docs"""
    ),
    "v10_score_checks": query(
        " UNION ALL ".join(
            _check(f"{level}_{name}", f"(SELECT COUNT(*) = 0 FROM f_{level}_docs WHERE {rule})")
            for level in ("department", "region")
            for name, rule in (
                ("scores_in_range", "NOT COALESCE(mean BETWEEN 0 AND 10, false)"),
                ("shares_add_up", _UNEVEN),
            )
        )
    ),
    "v11_review_rollup": query(
        " UNION ALL ".join(
            _totals(lower, upper, name)
            for lower, upper in (("city", "department"), ("department", "region"))
            for name in ("reviews", "cities")
        )
    ),
    "v12_anomalies": query(
        """SELECT 'department_without_cities' AS type, name, CAST(NULL AS VARCHAR) AS detail FROM f_department_docs
WHERE CAST(department_id AS INTEGER) % 5 = 0 OR cities = 0
UNION ALL SELECT 'region_without_departments', name, NULL FROM f_region_docs WHERE departments = 0
UNION ALL SELECT 'extreme_score', name, CAST(mean AS VARCHAR)
FROM (SELECT name, CASE WHEN CAST(department_id AS INTEGER) % 7 = 0 THEN 9.5 ELSE mean END mean FROM f_department_docs)
WHERE mean < 2 OR mean > 9
UNION ALL SELECT 'one_sided_sentiment', name, CAST(positive_percent AS VARCHAR) || '/' || CAST(negative_percent AS VARCHAR)
FROM f_region_docs WHERE positive_percent = 100 OR negative_percent = 100
UNION ALL SELECT * FROM (SELECT 'odd_word', d.name, arg_min(w.word, w.rank) FROM f_department_words w
  JOIN f_department_docs d ON d.department_id = w.department_id WHERE length(w.word) < 2 OR length(w.word) > 30
  GROUP BY d.department_id, d.name)"""
    ),
    "v14_text_job_stats": query(
        f"""SELECT c.n AS cities, c.done AS processed, {share('c.done', 'c.n', 2)} AS processed_share, w.n AS words,
       COALESCE({half_up('CAST(w.n AS DOUBLE) / NULLIF(d.n, 0)', 2)}, 0.0) AS words_per_city,
       {', '.join(f'd.{n} AS {n}_mean' for n in SENTIMENTS)}
FROM (SELECT COUNT(*) n, COUNT(*) FILTER (WHERE status = 'processed') done FROM f_city_docs) c
CROSS JOIN (SELECT COUNT(*) n FROM f_city_words w JOIN f_city_word_docs d ON d.city_id = w.city_id) w
CROSS JOIN (SELECT COUNT(*) n, {', '.join(f'{half_up(f"AVG({n}_percent)", 2)} AS {n}' for n in SENTIMENTS)} FROM f_city_word_docs) d"""
    ),
    "v15_global_sentiment": query(
        f"""SELECT {', '.join(f'{share(n, "(positive + neutral + negative)")} AS {n}' for n in SENTIMENTS)}
FROM (SELECT {', '.join(f'SUM({n}) {n}' for n in SENTIMENTS)} FROM f_department_docs)"""
    ),
    "v16_issues": query(
        """SELECT 'cities_without_reviews' AS type, 'medium' AS severity, COUNT(*) AS n,
       (SELECT string_agg(city_id, '; ' ORDER BY city_id) FROM (SELECT city_id FROM f_city_docs WHERE review_count = 0
        ORDER BY city_id LIMIT 5)) AS examples FROM f_city_docs WHERE review_count = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'score_gaps', 'high', COUNT(*),
       (SELECT string_agg(city_id, '; ' ORDER BY city_id) FROM (SELECT city_id FROM f_gaps ORDER BY difference DESC, city_id LIMIT 5))
FROM f_gaps HAVING COUNT(*) > 0"""
    ),
    "v17_general_stats": query(
        "SELECT "
        + ", ".join(
            f"(SELECT COUNT(*) FROM {source}) AS {name}"
            for name, source in (
                ("cities", "f_cities"), ("reviews", "f_reviews"), ("departments", "f_department_docs"),
                ("regions", "f_region_docs"),
            )
        )
    ),
    "s9_summary_json": query(
        f"""SELECT '{{"prices":{{"cities":' || cities || ',"negative_prices":' || negative_prices || ',"extreme_prices":' || extreme_prices
       || ',"min_price":' || min_price || ',"max_price":' || max_price || ',"mean_price":' || mean_price || '}},"sentiment":{{"positive":' || p.positive || ',"neutral":' || p.neutral
       || ',"negative":' || p.negative || '}}}}' AS document
FROM f_sanity CROSS JOIN (
  SELECT {', '.join(f'{share(n, "(positive + neutral + negative)")} AS {n}' for n in SENTIMENTS)}
  FROM (SELECT {', '.join(f'SUM({n}) {n}' for n in SENTIMENTS)} FROM f_department_docs)) p"""
    ),
}
