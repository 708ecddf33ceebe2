"""Registered queries on words, sentiment and review roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions.codes import sentiment
from geoledger.functions.text import normalize_text
from geoledger.operators import rankings as K
from geoledger.operators import reviews as R
from geoledger.operators import words as T
from geoledger.operators.imports import review_rollup
from geoledger.plans import inputs as I
from geoledger.sources import bindings as B
from geoledger.sources.scratch import scratch_path

SENTIMENT_COLUMNS = [*C.SENTIMENTS, *[f"{name}_percent" for name in C.SENTIMENTS]]


def _tokens(spark: SparkSession, sf: str) -> DataFrame:
    return T.tokens(B.reviews(spark, sf), B.lexicon(spark))


def _tokens_by_review(spark: SparkSession, sf: str) -> DataFrame:
    return T.tokens(T.in_pieces(B.reviews(spark, sf)), B.lexicon(spark))


def _per_token(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def t1_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return B.reviews(spark, sf).select("review_id", normalize_text(F.col("description")).alias("clean"))


def t3_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _per_token(_tokens_by_review(spark, sf), "review_id", "token", "lemma", "pos", "is_stop")


def t4_drop_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    return _per_token(T.drop_stopwords(_tokens(spark, sf)), "token", "lemma")


def t5_drop_derived(spark: SparkSession, sf: str) -> DataFrame:
    return _per_token(T.drop_derived(_tokens(spark, sf)), "token", "lemma")


def t6_content_words(spark: SparkSession, sf: str) -> DataFrame:
    return _per_token(T.keep_content_words(_tokens(spark, sf)), "token", "pos")


def t7_canonical_words(spark: SparkSession, sf: str) -> DataFrame:
    return _per_token(T.significant(_tokens_by_review(spark, sf)), "review_id", "word")


def t8_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return B.reviews(spark, sf).select("review_id", "score", sentiment(F.col("score")).alias("sentiment"))


def w1_city_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return T.city_sentiment(B.reviews(spark, sf))


def w2_city_words(spark: SparkSession, sf: str) -> DataFrame:
    return T.city_words(B.reviews(spark, sf), B.lexicon(spark))


def w3_department_words(spark: SparkSession, sf: str) -> DataFrame:
    return T.department_words(I.city_word_docs(spark, sf), B.city_documents(spark, sf))


def w4_region_words(spark: SparkSession, sf: str) -> DataFrame:
    return T.region_words(I.department_docs(spark, sf))


def w5_national_words(spark: SparkSession, sf: str) -> DataFrame:
    city = I.stored_city_word_docs(spark, sf)
    department = R.department_documents(city, B.city_documents(spark, sf), B.departments(spark, sf))
    return T.national_words(city, 50).withColumn("source", F.lit("city")).unionByName(
        T.national_words(department, 30).withColumn("source", F.lit("department"))
    )


def w6_word_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    maps = T.word_frequencies(I.city_word_docs(spark, sf))
    return maps.select("city_id", F.explode("word_frequencies").alias("word", "weight"))


def w7_sentiment_series(spark: SparkSession, sf: str) -> DataFrame:
    return T.sentiment_series(I.city_word_docs(spark, sf))


def r1_department_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return R.department_reviews(B.city_documents(spark, sf))


def r2_department_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return R.department_sentiment(I.city_word_docs(spark, sf), B.city_documents(spark, sf))


def _flat(docs: DataFrame, *columns: str) -> DataFrame:
    """Nested document as flat columns; the word list as its length and first word."""
    return docs.select(
        *columns,
        *[F.col(f"scores.{name}").alias(name) for name in C.SCORES],
        *[F.col(f"sentiment.{name}").alias(name) for name in SENTIMENT_COLUMNS],
        F.size("words").alias("words"),
        F.get("words", F.lit(0))["word"].alias("first_word"),
    )


def r3_department_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(I.department_docs(spark, sf), "department_id", "name", "region_id", "cities", "reviews")


def r4_region_reviews(spark: SparkSession, sf: str) -> DataFrame:
    rows = R.region_reviews(I.stored_department_docs(spark, sf))
    return rows.select(
        "region_id", "departments", "cities", "reviews", F.posexplode("department_list").alias("position", "item")
    ).select(
        "region_id", "departments", "cities", "reviews", "position", "item.department_id", F.col("item.name").alias("name")
    )


def r5_region_scores(spark: SparkSession, sf: str) -> DataFrame:
    return R.region_scores(I.department_docs(spark, sf))


def r6_region_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return R.region_sentiment(I.department_docs(spark, sf))


def r7_region_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(I.region_docs(spark, sf), "region_id", "name", "departments", "cities", "reviews")


def r7_review_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Both levels stored from the documents of half of the cities, then from all laid over them."""
    docs, cities = I.stored_city_word_docs(spark, sf), B.city_documents(spark, sf)
    names = B.departments(spark, sf), B.regions(spark, sf)
    first, second = scratch_path(spark, "reviews"), scratch_path(spark, "reviews")
    review_rollup(docs.where(F.length("city_id") == 2), cities, *names, first)
    stored = review_rollup(docs, cities, *names, second, previous=first)["region"]
    return _flat(stored, "region_id", "name", "departments", "cities", "reviews")


def r8_city_details(spark: SparkSession, sf: str) -> DataFrame:
    ids = B.cities(spark, sf).select("city_id").unionByName(B.reviews(spark, sf).select("city_id")).distinct()
    details = R.city_details(ids, B.city_documents(spark, sf), I.city_word_docs(spark, sf))
    weights = F.aggregate(F.map_values("word_frequencies"), F.lit(0).cast("bigint"), lambda total, w: total + w)
    return details.select(
        "city_id",
        "review_count",
        *[F.col(f"grades.{name}").alias(name) for name in C.SCORES],
        *[F.col(f"sentiment.{name}").alias(name) for name in SENTIMENT_COLUMNS],
        F.size("word_frequencies").alias("words"),
        weights.alias("weight"),
    )


def k2_extreme_cities(spark: SparkSession, sf: str) -> DataFrame:
    return K.extreme_cities(I.city_word_docs(spark, sf))


def k3_top_reviewed(spark: SparkSession, sf: str) -> DataFrame:
    return K.top_reviewed(B.reviews(spark, sf), B.city_documents(spark, sf))


def k8_best_departments(spark: SparkSession, sf: str) -> DataFrame:
    return K.best_departments(B.reviews(spark, sf), B.city_documents(spark, sf))


def k9_top_rated_departments(spark: SparkSession, sf: str) -> DataFrame:
    return K.top_rated_departments(I.department_docs(spark, sf))


def k11_coherence_sample(spark: SparkSession, sf: str) -> DataFrame:
    sample = K.coherence_sample(I.city_word_docs(spark, sf))
    return sample.select(
        "city_id",
        "city_name",
        *[F.col(f"sentiment.{name}_percent").alias(f"{name}_percent") for name in C.SENTIMENTS],
        F.array_join(F.col("words.word"), " ").alias("words"),
    )


def k12_review_sample(spark: SparkSession, sf: str) -> DataFrame:
    return K.review_sample(B.city_documents(spark, sf), B.reviews(spark, sf), 42).drop("description")


def k13_score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    departments = I.stored_department_docs(spark, sf).select(F.col("scores.mean").alias("mean"))
    return K.histogram(departments, "mean", 20)


def k13_positive_histogram(spark: SparkSession, sf: str) -> DataFrame:
    shares = I.stored_city_word_docs(spark, sf).select(F.col("sentiment.positive_percent").alias("share"))
    return K.histogram(shares, "share", 20, 0, 100)


def k14_volume_score_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return K.volume_score_pairs(I.department_docs(spark, sf))


def k15_sentiment_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return K.sentiment_matrix(I.region_docs(spark, sf))


QUERIES = {f.__name__: f for f in (
    t1_normalize, t3_tokens, t4_drop_stopwords, t5_drop_derived, t6_content_words, t7_canonical_words, t8_sentiment,
    w1_city_sentiment, w2_city_words, w3_department_words, w4_region_words, w5_national_words, w6_word_frequencies,
    w7_sentiment_series, r1_department_reviews, r2_department_sentiment, r3_department_documents, r4_region_reviews,
    r5_region_scores, r6_region_sentiment, r7_region_documents, r7_review_rollup, r8_city_details, k2_extreme_cities, k3_top_reviewed,
    k8_best_departments, k9_top_rated_departments, k11_coherence_sample, k12_review_sample, k13_score_histogram,
    k13_positive_histogram, k14_volume_score_pairs, k15_sentiment_matrix,
)}
