"""Ratings and sentiment of departments and regions, and the documents that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions.numbers import percent, ratio, round_half_up, struct_of
from geoledger.operators.words import department_words, region_words, sentiment_struct, word_lists

_NO_WORDS = "array<struct<word:string,weight:bigint>>"


def _members(cities: DataFrame) -> DataFrame:
    """Cities that count: at least one review and a department code."""
    return cities.where((F.col("department_id") != "") & (F.col("review_count") > 0))


def department_reviews(cities: DataFrame) -> DataFrame:
    """Cities, reviews and plain mean of the six scores per department."""
    return (
        _members(cities)
        .groupBy("department_id")
        .agg(
            F.count(F.lit(1)).alias("cities"),
            F.sum("review_count").alias("reviews"),
            *[round_half_up(F.avg(f"scores.{name}"), 1).alias(name) for name in C.SCORES],
        )
    )


def _sentiment_totals(df: DataFrame, key: str) -> DataFrame:
    counts = df.groupBy(key).agg(*[F.sum(f"sentiment.{name}").alias(name) for name in C.SENTIMENTS])
    total = F.col("positive") + F.col("neutral") + F.col("negative")
    return counts.select(
        key, *C.SENTIMENTS, *[percent(F.col(name), total).alias(f"{name}_percent") for name in C.SENTIMENTS]
    )


def department_sentiment(city_docs: DataFrame, cities: DataFrame) -> DataFrame:
    members = _members(cities).select("city_id", "department_id")
    return _sentiment_totals(city_docs.select("city_id", "sentiment").join(members, "city_id"), "department_id")


def with_area_names(df: DataFrame, areas: DataFrame, key: str, label: str) -> DataFrame:
    """Name (and region of a department) from the reference table, "label + id" for unknown ids."""
    columns = [key, "name", *(["region_id"] if key == "department_id" else [])]
    named = df.join(areas.select(*columns), key, "left").withColumn(
        "name", F.coalesce("name", F.concat(F.lit(label), F.col(key)))
    )
    if key == "department_id":
        named = named.withColumn("region_id", F.coalesce("region_id", F.lit("")))
    return named


def _scores() -> Column:
    return F.struct(*C.SCORES).alias("scores")


def _words() -> Column:
    return F.coalesce("words", F.array().cast(_NO_WORDS)).alias("words")


def department_documents(city_docs: DataFrame, cities: DataFrame, departments: DataFrame) -> DataFrame:
    """One document per department with reviewed cities."""
    moods = department_sentiment(city_docs, cities).select("department_id", sentiment_struct())
    words = word_lists(department_words(city_docs, cities), ["department_id"])
    return (
        department_reviews(cities)
        .join(moods, "department_id", "left")
        .join(words, "department_id", "left")
        .transform(with_area_names, departments, "department_id", C.DEPARTMENT_LABEL)
        .select("department_id", "name", "region_id", "cities", "reviews", _scores(), "sentiment", _words())
    )


def region_reviews(department_docs: DataFrame) -> DataFrame:
    """Departments, cities, reviews and the ordered department list of each region."""
    listed = F.array_sort(F.collect_list(F.struct("department_id", "name")))
    return (
        department_docs.where(F.col("region_id") != "")
        .groupBy("region_id")
        .agg(
            F.count(F.lit(1)).alias("departments"),
            F.sum("cities").alias("cities"),
            F.sum("reviews").alias("reviews"),
            listed.alias("department_list"),
        )
    )


def region_scores(department_docs: DataFrame) -> DataFrame:
    """Scores weighted by number of cities, 0.0 without weight."""

    def score(name: str) -> Column:
        value, weight = F.col(f"scores.{name}"), F.col("cities")
        known = F.when(value.isNotNull(), weight)
        return F.coalesce(round_half_up(ratio(F.sum(value * weight), F.sum(known)), 1), F.lit(0.0))

    return (
        department_docs.where(F.col("region_id") != "")
        .groupBy("region_id")
        .agg(*[score(name).alias(name) for name in C.SCORES])
    )


def region_sentiment(department_docs: DataFrame) -> DataFrame:
    return _sentiment_totals(department_docs.where(F.col("region_id") != ""), "region_id")


def region_documents(department_docs: DataFrame, regions: DataFrame) -> DataFrame:
    """One document per region with reviewed departments."""
    moods = region_sentiment(department_docs).select("region_id", sentiment_struct())
    words = word_lists(region_words(department_docs.where(F.col("region_id") != "")), ["region_id"])
    return (
        region_reviews(department_docs)
        .join(region_scores(department_docs), "region_id")
        .join(moods, "region_id")
        .join(words, "region_id", "left")
        .transform(with_area_names, regions, "region_id", C.REGION_LABEL)
        .select(
            "region_id", "name", "departments", "cities", "reviews", _scores(), "sentiment", _words(),
            F.col("department_list"),
        )
    )


def city_details(ids: DataFrame, cities: DataFrame, city_docs: DataFrame) -> DataFrame:
    """Detail document of each asked city: all parts, or zeros when ratings or words are missing."""
    ratings = cities.select("city_id", "scores", "review_count", F.lit(True).alias("_rated"))
    texts = city_docs.select("city_id", "words", "sentiment", F.lit(True).alias("_worded"))
    joined = ids.select("city_id").join(ratings, "city_id", "left").join(texts, "city_id", "left")
    whole = F.col("_rated") & F.col("_worded")

    def part(value: Column, empty: Column) -> Column:
        return F.coalesce(F.when(whole, value), empty)

    zero_count = F.lit(0).cast("bigint")
    grades = struct_of({name: part(F.col(f"scores.{name}"), F.lit(0.0)) for name in C.SCORES})
    mood = struct_of(
        {name: part(F.col(f"sentiment.{name}"), zero_count) for name in C.SENTIMENTS}
        | {f"{n}_percent": part(F.col(f"sentiment.{n}_percent"), F.lit(0.0)) for n in C.SENTIMENTS}
    )
    no_words = F.create_map().cast("map<string,bigint>")
    return joined.select(
        "city_id",
        grades.alias("grades"),
        part(F.col("review_count"), zero_count).alias("review_count"),
        part(F.map_from_entries("words"), no_words).alias("word_frequencies"),
        mood.alias("sentiment"),
    )
