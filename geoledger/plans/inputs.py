"""Inputs of the registered queries, bound to the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoledger.functions.geometry import Viewport
from geoledger.operators import reviews as R
from geoledger.operators import statistics as A
from geoledger.operators import words as T
from geoledger.sources import bindings as B
from geoledger.sources.scratch import materialise

REGION_VIEW = Viewport(5, 41, -6, 52, 10)
DEPARTMENT_VIEW = Viewport(8, 43, 0, 46, 4)
CITY_VIEW = Viewport(12, 44, 1, 45, 2)


def city_stats(spark: SparkSession, sf: str) -> DataFrame:
    return A.city_stats(B.cities(spark, sf), B.transactions(spark, sf))


def stored_city_stats(spark: SparkSession, sf: str) -> DataFrame:
    """City statistics written once: the upper levels read them several times."""
    return materialise(city_stats(spark, sf), "city-stats")


def department_stats(spark: SparkSession, sf: str, cities: DataFrame | None = None) -> DataFrame:
    return A.department_stats(B.departments(spark, sf), cities or stored_city_stats(spark, sf))


def region_stats(spark: SparkSession, sf: str, departments: DataFrame | None = None) -> DataFrame:
    departments = departments or materialise(department_stats(spark, sf), "department-stats")
    return A.region_stats(B.regions(spark, sf), departments)


def all_stats(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The three levels, each computed once."""
    city = stored_city_stats(spark, sf)
    department = materialise(department_stats(spark, sf, city), "department-stats")
    return {"city": city, "department": department, "region": region_stats(spark, sf, department)}


def area_levels(spark: SparkSession, sf: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    stats = all_stats(spark, sf)
    areas = {"city": B.cities, "department": B.department_areas, "region": B.region_areas}
    return {level: (areas[level](spark, sf), stats[level]) for level in areas}


def city_word_docs(spark: SparkSession, sf: str) -> DataFrame:
    return T.city_word_documents(B.cities(spark, sf), B.reviews(spark, sf), B.lexicon(spark))


def stored_city_word_docs(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(city_word_docs(spark, sf), "city-words")


def department_docs(spark: SparkSession, sf: str) -> DataFrame:
    cities = materialise(B.city_documents(spark, sf), "city-documents")  # read by three aggregates
    return R.department_documents(stored_city_word_docs(spark, sf), cities, B.departments(spark, sf))


def stored_department_docs(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(department_docs(spark, sf), "department-reviews")


def region_docs(spark: SparkSession, sf: str, departments: DataFrame | None = None) -> DataFrame:
    return R.region_documents(departments or stored_department_docs(spark, sf), B.regions(spark, sf))
