"""Rankings, samples and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoledger.functions.numbers import ratio, round_half_up


def extreme_cities(city_docs: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most positive and the ``k`` most negative cities."""
    rows = city_docs.select(
        "city_id",
        "city_name",
        F.col("sentiment.positive_percent").alias("positive"),
        F.col("sentiment.negative_percent").alias("negative"),
    ).where(F.col("positive").isNotNull() & F.col("negative").isNotNull())

    def side(name: str) -> DataFrame:
        best = rows.orderBy(F.desc(name), F.asc("city_id")).limit(k)
        return best.select(F.lit(name).alias("side"), "city_id", "city_name", F.col(name).alias("share"))

    return side("positive").unionByName(side("negative"))


def top_reviewed(reviews: DataFrame, cities: DataFrame, k: int = 10) -> DataFrame:
    """Cities with most reviews, unknown cities included without a name."""
    counts = reviews.groupBy("city_id").agg(F.count(F.lit(1)).alias("reviews"))
    best = counts.orderBy(F.desc("reviews"), F.asc("city_id")).limit(k)
    return best.join(cities.select("city_id", "name", "postal_code"), "city_id", "left").select(
        "city_id", "name", "postal_code", "reviews"
    )


def top_cities(stats: DataFrame, by: str, k: int = 10) -> DataFrame:
    column = {"n": "transactions", "price": "price_mean"}[by]
    return (
        stats.where(F.col(column).isNotNull())
        .select("city_id", "name", "transactions", "price_mean", "price_m2_mean")
        .orderBy(F.desc(column), F.asc("city_id"))
        .limit(k)
    )


def top_departments(stats: DataFrame, departments: DataFrame, k: int = 10) -> DataFrame:
    """Departments with most sales under their current name."""
    names = departments.select("department_id", "name")
    return (
        stats.where(F.col("transactions") > 0)
        .select("department_id", "transactions", "price_mean", "cities")
        .join(names, "department_id")
        .orderBy(F.desc("transactions"), F.asc("department_id"))
        .limit(k)
    )


def regions_by_price(stats: DataFrame) -> DataFrame:
    """Regions from dear to cheap with their volume relative to the largest."""
    known = stats.where(F.col("price_mean").isNotNull()).select("region_id", "name", "price_mean", "transactions")
    largest = known.agg(F.max("transactions").alias("n")).scalar()
    share = round_half_up(ratio(F.col("transactions"), largest), 4)
    return known.withColumn("volume_share", share).orderBy(F.desc("price_mean"), F.asc("region_id"))


def best_departments(reviews: DataFrame, cities: DataFrame, minimum: int = 10, k: int = 10) -> DataFrame:
    """Best mean review score, ranked before it is rounded, among departments with more than ``minimum`` reviews.

    Scores are folded per city first: the join carries one row per city.
    """
    per_city = reviews.groupBy("city_id").agg(
        F.sum("score").alias("total"), F.count("score").alias("scored"), F.count(F.lit(1)).alias("n")
    )
    per_department = (
        per_city.join(cities.select("city_id", "department_id"), "city_id")
        .groupBy("department_id")
        .agg(ratio(F.sum("total"), F.sum("scored")).alias("mean"), F.sum("n").alias("reviews"))
    )
    return (
        per_department.where(F.col("reviews") > minimum)
        .orderBy(F.desc("mean"), F.asc("department_id"))
        .limit(k)
        .withColumn("mean", round_half_up(F.col("mean"), 2))
    )


def top_rated_departments(department_docs: DataFrame, k: int = 10) -> DataFrame:
    return (
        department_docs.select("department_id", "name", "cities", "reviews", F.col("scores.mean").alias("mean"))
        .orderBy(F.desc("mean"), F.asc("department_id"))
        .limit(k)
    )


def volume_outliers(stats: DataFrame, minimum: int = 10, k: int = 50, share: float = 0.9) -> DataFrame:
    """Largest departments; those above the 90th percentile of price or volume are labelled."""
    largest = (
        stats.where(F.col("price_mean").isNotNull() & (F.col("transactions") > minimum))
        .select("department_id", "name", "price_mean", "transactions")
        .orderBy(F.desc("transactions"), F.asc("department_id"))
        .limit(k)
    )
    kept = W.partitionBy()  # at most k rows
    labelled = (F.col("price_mean") > F.percentile("price_mean", share).over(kept)) | (
        F.col("transactions") > F.percentile("transactions", share).over(kept)
    )
    return largest.withColumn("label", F.when(labelled, F.col("name")))


def coherence_sample(city_docs: DataFrame, cities: int = 5, words: int = 10) -> DataFrame:
    """First cities with their sentiment and first words."""
    return (
        city_docs.select("city_id", "city_name", "sentiment", F.slice("words", 1, words).alias("words"))
        .orderBy("city_id")
        .limit(cities)
    )


def _draw(seed: int, *keys: str):
    """Repeatable random order: a hash of seed and key, the same after any recomputation."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *keys))


def review_sample(cities: DataFrame, reviews: DataFrame, seed: int, n_cities: int = 5, n_reviews: int = 3) -> DataFrame:
    """Random cities and up to three random reviews of each; cities without reviews stay."""
    chosen = (
        cities.select("city_id", "name", "postal_code", "review_count")
        .orderBy(_draw(seed, "city_id"), "city_id")
        .limit(n_cities)
    )
    order = W.partitionBy("city_id").orderBy(_draw(seed, "review_id"), "review_id")
    drawn = (
        reviews.select("city_id", "review_id", "score", "description")
        .join(F.broadcast(chosen.select("city_id")), "city_id", "left_semi")  # n_cities rows
        .withColumn("draw", F.row_number().over(order))
        .where(F.col("draw") <= n_reviews)
    )
    return chosen.join(drawn, "city_id", "left")


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width bins from ``lo`` to ``hi`` (the data's range unless given), the last one closed."""
    known = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    low = known.agg(F.min("v").alias("v")).scalar() if lo is None else F.lit(float(lo))
    high = known.agg(F.max("v").alias("v")).scalar() if hi is None else F.lit(float(hi))
    flat = low == high
    first, last = F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)
    width = (last - first) / bins
    bucket = F.least(F.floor((F.col("v") - first) / width), F.lit(bins - 1)) + 1
    counts = (
        known.where(F.col("v").between(first, last)).groupBy(bucket.cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    )
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bucket"))
    return every.join(counts, "bucket", "left").select(
        "bucket",
        round_half_up(first + width * (F.col("bucket") - 1), 4).alias("low"),
        round_half_up(first + width * F.col("bucket"), 4).alias("high"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def area_histogram(stats: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Distribution of a city's mean areas without the extremes of either."""
    usual = stats.where((F.col("built_mean") < 1000) & (F.col("land_mean") < 10000))
    return histogram(usual, col, bins)


def volume_score_pairs(department_docs: DataFrame) -> DataFrame:
    return department_docs.select("department_id", "name", "reviews", F.col("scores.mean").alias("mean"))


def sentiment_matrix(region_docs: DataFrame) -> DataFrame:
    """Sentiment shares per region, most positive first."""
    zero = F.lit(0.0)
    return region_docs.select(
        "region_id",
        "name",
        *[
            F.coalesce(f"sentiment.{name}_percent", zero).alias(name)
            for name in ("positive", "neutral", "negative")
        ],
    ).orderBy(F.desc("positive"), F.asc("region_id"))
