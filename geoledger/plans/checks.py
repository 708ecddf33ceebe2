"""Registered queries on data quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.operators import quality as V
from geoledger.plans import inputs as I
from geoledger.sources import bindings as B

CITY_FIELDS = ["name", "postal_code", "insee_code", "city_id", "department_id", "url", "scores", "review_count"]
REVIEW_FIELDS = ["city_id", "review_id", "author", "review_date", "score", "safety", "description", "url"]


def _docs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    department = I.stored_department_docs(spark, sf)
    return department, I.region_docs(spark, sf, department)


def s11_profile(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"regions": B.regions(spark, sf), "departments": B.departments(spark, sf), "transactions": B.transactions(spark, sf)}
    return V.profile(tables).drop("example")


def s11_profile_by_name(spark: SparkSession, sf: str) -> DataFrame:
    stats = I.all_stats(spark, sf)
    return V.profile({f"{level}_stats": df for level, df in stats.items()}, "transaction").drop("example")


def s12_required_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return V.require_nonempty(
        {"departments": B.departments(spark, sf), "regions": B.regions(spark, sf), "transactions": B.transactions(spark, sf)},
        strict=True,
    )


def x1_table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return V.table_counts(
        {
            "cities": B.cities(spark, sf),
            "departments": B.departments(spark, sf),
            "regions": B.regions(spark, sf),
            "transactions": B.transactions(spark, sf),
            "city_stats": I.city_stats(spark, sf),
        }
    )


def j8_orphan_city_ids(spark: SparkSession, sf: str) -> DataFrame:
    return V.orphan_city_ids(B.reviews(spark, sf), B.cities(spark, sf))


def j9_cities_without_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return V.cities_without_reviews(B.cities(spark, sf), B.reviews(spark, sf))


def j9_cities_counted_empty(spark: SparkSession, sf: str) -> DataFrame:
    return V.cities_counted_empty(B.city_documents(spark, sf))


def v1_review_totals(spark: SparkSession, sf: str) -> DataFrame:
    return V.review_totals(B.cities(spark, sf), B.reviews(spark, sf))


def v2_reviews_per_city(spark: SparkSession, sf: str) -> DataFrame:
    return V.reviews_per_city(B.reviews(spark, sf))


def v3_score_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return V.score_gaps(B.reviews(spark, sf), B.city_documents(spark, sf), 0.5, 50)


def v4_missing_fields(spark: SparkSession, sf: str) -> DataFrame:
    cities = V.missing_fields(B.city_documents(spark, sf), CITY_FIELDS + [f"scores.{s}" for s in C.SCORES])
    reviews = V.missing_fields(B.reviews(spark, sf), REVIEW_FIELDS)
    return cities.withColumn("table", F.lit("cities")).unionByName(reviews.withColumn("table", F.lit("reviews")))


def v4_empty_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    return V.empty_descriptions(B.reviews(spark, sf))


def v5_score_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return V.score_distribution(B.reviews(spark, sf))


def v5_category_means(spark: SparkSession, sf: str) -> DataFrame:
    return V.category_means(B.reviews(spark, sf))


def v8_document_checks(spark: SparkSession, sf: str) -> DataFrame:
    department, region = _docs(spark, sf)
    return V.validate_departments(department, B.departments(spark, sf)).unionByName(
        V.validate_regions(region, B.regions(spark, sf))
    )


def v9_count_ranges(spark: SparkSession, sf: str) -> DataFrame:
    department, region = _docs(spark, sf)
    return V.count_ranges({"departments": department, "regions": region}, {"departments": (90, 110), "regions": (12, 18)})


def v10_score_checks(spark: SparkSession, sf: str) -> DataFrame:
    return V.score_checks(*_docs(spark, sf))


def v11_review_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return V.review_rollup_check(B.city_documents(spark, sf), *_docs(spark, sf))


def v12_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as stored, plus a level with an emptied department and an odd score."""
    department, region = _docs(spark, sf)
    number = F.col("department_id").cast("int")
    drifted = department.withColumns(
        {
            "cities": F.when(number % 5 == 0, 0).otherwise(F.col("cities")),
            "scores": F.col("scores").withField("mean", F.when(number % 7 == 0, 9.5).otherwise(F.col("scores.mean"))),
        }
    )
    return V.anomalies(drifted, region)


def v14_text_job_stats(spark: SparkSession, sf: str) -> DataFrame:
    return V.text_job_stats(B.city_documents(spark, sf), I.city_word_docs(spark, sf))


def v15_global_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return V.global_sentiment(I.department_docs(spark, sf))


def v16_issues(spark: SparkSession, sf: str) -> DataFrame:
    return V.issues(B.city_documents(spark, sf), B.reviews(spark, sf))


def v17_general_stats(spark: SparkSession, sf: str) -> DataFrame:
    return V.general_stats(B.cities(spark, sf), B.reviews(spark, sf), *_docs(spark, sf))


def s9_summary_json(spark: SparkSession, sf: str) -> DataFrame:
    groups = {"prices": V.price_sanity(I.city_stats(spark, sf)), "sentiment": V.global_sentiment(I.department_docs(spark, sf))}
    return V.summary_json(groups)


QUERIES = {f.__name__: f for f in (
    s11_profile, s11_profile_by_name, s12_required_inputs, x1_table_counts, j8_orphan_city_ids,
    j9_cities_without_reviews, j9_cities_counted_empty, v1_review_totals, v2_reviews_per_city, v3_score_gaps,
    v4_missing_fields, v4_empty_descriptions, v5_score_distribution, v5_category_means, v8_document_checks,
    v9_count_ranges, v10_score_checks, v11_review_rollup, v12_anomalies, v14_text_job_stats, v15_global_sentiment,
    v16_issues, v17_general_stats, s9_summary_json,
)}
