"""SQL twins of the queries on words, sentiment and review roll-ups."""

from __future__ import annotations

from geoledger import constants as C
from geoledger.sources.lexicon import ROWS
from oracle.base import CATEGORIES, SCORES, SENTIMENTS, fragment, half_up, query, share

_PERCENTS = [f"{n}_percent" for n in SENTIMENTS]
_MOOD = ", ".join([*SENTIMENTS, *_PERCENTS])


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _case(column: str, table: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table.items()) + f" ELSE {column} END"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


_CLEAN = (
    r"COALESCE(trim(regexp_replace(regexp_replace(lower(description), '[^\p{L}\s]', ' ', 'g'), ' {2,}', ' ', 'g'), "
    r"' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)), '')"
)
_STEMS = sorted({w[:3] for w in C.UNINFORMATIVE_LEMMAS if len(w) > 3})
_NOT_STOP = f"NOT is_stop AND lemma NOT IN ({_list(C.UNINFORMATIVE_LEMMAS)})"
_NOT_DERIVED = f"NOT (length(lemma) > 3 AND substr(lemma, 1, 3) IN ({_list(_STEMS)}))"
_CONTENT = "pos IN ('NOUN', 'ADJ', 'PROPN') AND length(token) >= 3"
_KIND = "CASE WHEN COALESCE(score, 0) >= 4 THEN 'positive' WHEN COALESCE(score, 0) <= 2 THEN 'negative' ELSE 'neutral' END"

fragment("f_lexicon", f"SELECT * FROM (VALUES {_values(ROWS)}) t(token, lemma, pos, is_stop)")
fragment(
    "f_tokens",
    f"""SELECT t.review_id, t.city_id, t.token, lower(COALESCE(x.lemma, t.token)) lemma, COALESCE(x.pos, 'NOUN') pos,
       COALESCE(x.is_stop, false) is_stop
FROM (SELECT review_id, city_id, unnest(string_split_regex({_CLEAN}, '\\s+')) token FROM f_reviews
      WHERE length(description) >= 3) t LEFT JOIN f_lexicon x ON x.token = t.token WHERE t.token <> ''""",
)
fragment(
    "f_words",
    f"""SELECT review_id, city_id, {_case('fixed', C.FORM_NORMALISATION)} word
FROM (SELECT review_id, city_id, {_case('lemma', C.LEMMA_CORRECTIONS)} fixed FROM f_tokens
      WHERE {_NOT_STOP} AND {_NOT_DERIVED} AND {_CONTENT})""",
)


def _top(source: str, key: str, k: int) -> str:
    return f"""SELECT {key}, word, weight, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY weight DESC, word) rank FROM ({source})) WHERE rank <= {k}"""


fragment(
    "f_city_words",
    _top("SELECT city_id, word, COUNT(*) weight FROM f_words GROUP BY city_id, word", "city_id", C.CITY_WORDS),
)
fragment(
    "f_city_mood",
    f"""SELECT city_id, reviews, {', '.join(SENTIMENTS)}, {', '.join(f'{share(n, "reviews")} AS {n}_percent' for n in SENTIMENTS)}
FROM (SELECT city_id, COUNT(*) reviews, {', '.join(f"COUNT(*) FILTER (WHERE kind = '{n}') {n}" for n in SENTIMENTS)}
      FROM (SELECT city_id, {_KIND} kind FROM f_reviews) GROUP BY city_id)""",
)
fragment(
    "f_city_word_docs",
    f"SELECT c.city_id, c.name AS city_name, {_MOOD} FROM f_cities c JOIN f_city_mood m ON m.city_id = c.city_id",
)
fragment("f_members", "SELECT city_id, department_id FROM f_city_docs WHERE department_id <> '' AND review_count > 0")
fragment(
    "f_department_words",
    _top(
        """SELECT m.department_id, w.word, CAST(SUM(w.weight) AS BIGINT) weight FROM f_city_words w
    JOIN f_members m ON m.city_id = w.city_id GROUP BY m.department_id, w.word""",
        "department_id",
        C.AREA_WORDS,
    ),
)
fragment(
    "f_department_reviews",
    f"""SELECT department_id, COUNT(*) cities, CAST(SUM(review_count) AS BIGINT) reviews,
       {', '.join(f'{half_up(f"AVG({n})", 1)} AS {n}' for n in SCORES)}
FROM f_city_docs WHERE department_id <> '' AND review_count > 0 GROUP BY department_id""",
)


def _mood(source: str, key: str) -> str:
    total = "(positive + neutral + negative)"
    return f"""SELECT {key}, {', '.join(SENTIMENTS)}, {', '.join(f'{share(n, total)} AS {n}_percent' for n in SENTIMENTS)}
FROM (SELECT {key}, {', '.join(f'CAST(SUM({n}) AS BIGINT) {n}' for n in SENTIMENTS)} FROM ({source}) GROUP BY {key})"""


fragment(
    "f_department_mood",
    _mood("SELECT m.department_id, d.* FROM f_city_word_docs d JOIN f_members m ON m.city_id = d.city_id", "department_id"),
)
fragment(
    "f_department_docs",
    f"""SELECT r.*, COALESCE(d.name, 'Département ' || r.department_id) name, COALESCE(d.region_id, '') region_id, {_MOOD}
FROM f_department_reviews r LEFT JOIN f_department_mood m ON m.department_id = r.department_id
LEFT JOIN f_departments d ON d.department_id = r.department_id""",
)
fragment(
    "f_region_words",
    _top(
        """SELECT d.region_id, w.word, CAST(SUM(w.weight) AS BIGINT) weight FROM f_department_words w
    JOIN f_department_docs d ON d.department_id = w.department_id GROUP BY d.region_id, w.word""",
        "region_id",
        C.AREA_WORDS,
    ),
)
fragment("f_region_mood", _mood("SELECT * FROM f_department_docs WHERE region_id <> ''", "region_id"))
fragment(
    "f_region_scores",
    f"""SELECT region_id, {', '.join(f'COALESCE({half_up(f"SUM({n} * cities) / NULLIF(SUM(cities), 0)", 1)}, 0.0) AS {n}' for n in SCORES)}
FROM f_department_docs WHERE region_id <> '' GROUP BY region_id""",
)
fragment(
    "f_region_docs",
    f"""SELECT t.region_id, COALESCE(r.name, 'Région ' || t.region_id) name, t.departments, t.cities, t.reviews,
       {', '.join('s.' + n for n in SCORES)}, {', '.join('m.' + n for n in [*SENTIMENTS, *_PERCENTS])}
FROM (SELECT region_id, COUNT(*) departments, CAST(SUM(cities) AS BIGINT) cities, CAST(SUM(reviews) AS BIGINT) reviews
      FROM f_department_docs WHERE region_id <> '' GROUP BY region_id) t
JOIN f_region_scores s ON s.region_id = t.region_id JOIN f_region_mood m ON m.region_id = t.region_id
LEFT JOIN f_regions r ON r.region_id = t.region_id""",
)


def _flat(level: str, columns: str) -> str:
    return f"""SELECT {columns}, {', '.join(SCORES)}, {_MOOD}, CAST(COALESCE(w.n, 0) AS INTEGER) AS words, w.first_word
FROM f_{level}_docs d LEFT JOIN (SELECT {level}_id, COUNT(*) n, MAX(CASE WHEN rank = 1 THEN word END) first_word
  FROM f_{level}_words GROUP BY {level}_id) w ON w.{level}_id = d.{level}_id"""


def _draw(*keys: str) -> str:
    return "md5('42:' || " + " || ':' || ".join(keys) + ")"


def _bins(source: str, lo: str, hi: str) -> str:
    return f"""SELECT CAST(b.range AS INTEGER) AS bucket, {half_up('lo + (hi - lo) / 20 * (b.range - 1)', 4)} AS low,
       {half_up('lo + (hi - lo) / 20 * b.range', 4)} AS high, COUNT(v.v) AS n
FROM range(1, 21) b CROSS JOIN (SELECT {lo} lo, {hi} hi FROM ({source})) r
LEFT JOIN (SELECT v, LEAST(FLOOR((v - lo) / ((hi - lo) / 20)), 19) + 1 bucket
           FROM ({source}) CROSS JOIN (SELECT {lo} lo, {hi} hi FROM ({source}))) v ON v.bucket = b.range
GROUP BY b.range, lo, hi"""


_ZERO_MOOD = ", ".join(
    [f"CASE WHEN ok THEN {n} ELSE 0 END AS {n}" for n in SENTIMENTS]
    + [f"CASE WHEN ok THEN {n} ELSE 0.0 END AS {n}" for n in _PERCENTS]
)

ORACLE = {
    "t1_normalize": query(f"SELECT review_id, {_CLEAN} AS clean FROM f_reviews"),
    "t3_tokens": query("SELECT review_id, token, lemma, pos, is_stop, COUNT(*) AS n FROM f_tokens GROUP BY ALL"),
    "t4_drop_stopwords": query(f"SELECT token, lemma, COUNT(*) AS n FROM f_tokens WHERE {_NOT_STOP} GROUP BY ALL"),
    "t5_drop_derived": query(f"SELECT token, lemma, COUNT(*) AS n FROM f_tokens WHERE {_NOT_DERIVED} GROUP BY ALL"),
    "t6_content_words": query(f"SELECT token, pos, COUNT(*) AS n FROM f_tokens WHERE {_CONTENT} GROUP BY ALL"),
    "t7_canonical_words": query("SELECT review_id, word, COUNT(*) AS n FROM f_words GROUP BY ALL"),
    "t8_sentiment": query(f"SELECT review_id, score, {_KIND} AS sentiment FROM f_reviews"),
    "w1_city_sentiment": query("SELECT * FROM f_city_mood"),
    "w2_city_words": query("SELECT * FROM f_city_words"),
    "w3_department_words": query("SELECT * FROM f_department_words"),
    "w4_region_words": query("SELECT * FROM f_region_words"),
    "w5_national_words": query(
        """SELECT 'city' AS source, word, weight FROM (SELECT w.word, CAST(SUM(w.weight) AS BIGINT) weight FROM f_city_words w
  JOIN f_city_word_docs d ON d.city_id = w.city_id GROUP BY w.word ORDER BY 2 DESC, 1 LIMIT 50)
UNION ALL SELECT 'department', word, weight FROM (SELECT word, CAST(SUM(weight) AS BIGINT) weight
  FROM f_department_words GROUP BY word ORDER BY 2 DESC, 1 LIMIT 30)"""
    ),
    "w6_word_frequencies": query(
        "SELECT w.city_id, w.word, w.weight FROM f_city_words w JOIN f_city_word_docs d ON d.city_id = w.city_id"
    ),
    "w7_sentiment_series": query(
        " UNION ALL ".join(
            f"SELECT city_id, {i} AS position, '{C.SENTIMENT_LABELS[n]}' AS label, {n} AS value, '{C.SENTIMENT_COLOURS[n]}' AS colour FROM f_city_word_docs"
            for i, n in enumerate(SENTIMENTS, start=1)
        )
    ),
    "r1_department_reviews": query("SELECT * FROM f_department_reviews"),
    "r2_department_sentiment": query("SELECT * FROM f_department_mood"),
    "r3_department_documents": query(_flat("department", "d.department_id, name, region_id, cities, reviews")),
    "r4_region_reviews": query(
        """SELECT d.region_id, t.departments, t.cities, t.reviews,
       CAST(row_number() OVER (PARTITION BY d.region_id ORDER BY d.department_id) - 1 AS INTEGER) AS position,
       d.department_id, d.name
FROM f_department_docs d JOIN f_region_docs t ON t.region_id = d.region_id"""
    ),
    "r5_region_scores": query("SELECT * FROM f_region_scores"),
    "r6_region_sentiment": query("SELECT * FROM f_region_mood"),
    "r7_region_documents": query(_flat("region", "d.region_id, name, departments, cities, reviews")),
    "r7_review_rollup": query(_flat("region", "d.region_id, name, departments, cities, reviews")),
    "r8_city_details": query(
        f"""SELECT city_id, CASE WHEN ok THEN review_count ELSE 0 END AS review_count,
       {', '.join(f'CASE WHEN ok THEN {n} ELSE 0.0 END AS {n}' for n in SCORES)}, {_ZERO_MOOD},
       CAST(CASE WHEN ok THEN COALESCE(words, 0) ELSE 0 END AS INTEGER) AS words,
       CAST(CASE WHEN ok THEN COALESCE(weight, 0) ELSE 0 END AS BIGINT) AS weight
FROM (SELECT i.city_id, c.city_id IS NOT NULL AND d.city_id IS NOT NULL ok, c.review_count,
             {', '.join('c.' + n for n in SCORES)}, {_MOOD}, w.words, w.weight
      FROM (SELECT city_id FROM f_cities UNION SELECT city_id FROM f_reviews) i
      LEFT JOIN f_city_docs c ON c.city_id = i.city_id LEFT JOIN f_city_word_docs d ON d.city_id = i.city_id
      LEFT JOIN (SELECT city_id, COUNT(*) words, SUM(weight) weight FROM f_city_words GROUP BY city_id) w
        ON w.city_id = i.city_id)"""
    ),
    "k2_extreme_cities": query(
        " UNION ALL ".join(
            f"""SELECT * FROM (SELECT '{side}' AS side, city_id, city_name, {side}_percent AS share FROM f_city_word_docs
ORDER BY share DESC, city_id LIMIT 5)"""
            for side in ("positive", "negative")
        )
    ),
    "k3_top_reviewed": query(
        """SELECT r.city_id, c.name, c.postal_code, r.reviews FROM (SELECT city_id, COUNT(*) reviews FROM f_reviews
  GROUP BY city_id ORDER BY reviews DESC, city_id LIMIT 10) r LEFT JOIN f_city_docs c ON c.city_id = r.city_id"""
    ),
    "k8_best_departments": query(
        f"""SELECT department_id, {half_up('AVG(r.score)', 2)} AS mean, COUNT(*) AS reviews FROM f_reviews r
JOIN f_cities c ON c.city_id = r.city_id GROUP BY department_id HAVING COUNT(*) > 10
ORDER BY AVG(r.score) DESC, department_id LIMIT 10"""
    ),
    "k9_top_rated_departments": query(
        """SELECT department_id, name, cities, reviews, mean FROM f_department_docs
ORDER BY mean DESC, department_id LIMIT 10"""
    ),
    "k11_coherence_sample": query(
        f"""SELECT d.city_id, d.city_name, {', '.join('d.' + n for n in _PERCENTS)},
       (SELECT string_agg(word, ' ' ORDER BY rank) FROM f_city_words w WHERE w.city_id = d.city_id AND rank <= 10) AS words
FROM (SELECT * FROM f_city_word_docs ORDER BY city_id LIMIT 5) d"""
    ),
    "k12_review_sample": query(
        f"""SELECT c.city_id, c.name, c.postal_code, c.review_count, r.review_id, r.score, r.draw
FROM (SELECT * FROM f_city_docs ORDER BY {_draw('city_id')}, city_id LIMIT 5) c
LEFT JOIN (SELECT * FROM (SELECT city_id, review_id, score,
             CAST(row_number() OVER (PARTITION BY city_id ORDER BY {_draw('review_id')}, review_id) AS INTEGER) draw
           FROM f_reviews) WHERE draw <= 3) r ON r.city_id = c.city_id"""
    ),
    "k13_score_histogram": query(_bins("SELECT mean v FROM f_department_docs", "MIN(v)", "MAX(v)")),
    "k13_positive_histogram": query(
        _bins("SELECT positive_percent v FROM f_city_word_docs", "MIN(0.0::DOUBLE)", "MAX(100.0::DOUBLE)")
    ),
    "k14_volume_score_pairs": query("SELECT department_id, name, reviews, mean FROM f_department_docs"),
    "k15_sentiment_matrix": query(
        """SELECT region_id, name, positive_percent AS positive, neutral_percent AS neutral, negative_percent AS negative
FROM f_region_docs ORDER BY positive DESC, region_id"""
    ),
}
