"""Property statistics: cities from sales, departments from cities, regions from departments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.functions.geometry import mercator_area
from geoledger.functions.medians import aggregate_with_medians
from geoledger.functions.numbers import rounded, weighted_mean
from geoledger.operators.transactions import positive_sales

MEASURES = (
    "price_mean", "price_median", "price_min", "price_max", "price_m2_mean", "price_m2_median",
    "built_mean", "built_median", "land_mean", "land_median",
)
MEDIANS = tuple(name for name in MEASURES if name.endswith("_median"))
DENSITY = "density_per_mercator_km2"
COUNTERS = ("transactions", "transactions_built", "transactions_land")


def _rounded() -> list:
    return [
        *[rounded(name, 2) for name in MEASURES],
        "first_date",
        "last_date",
        rounded(DENSITY, 4),
    ]


def city_stats(cities: DataFrame, tx: DataFrame) -> DataFrame:
    """One row per city with at least one sale of positive price.

    Sales are folded per city before the cities are joined, so a city with most of the sales reaches
    the join as one row, and its medians are taken without gathering its sales.
    """
    sales = positive_sales(tx)
    totals = [
        F.count("tx_id").alias("transactions"),
        F.count("built").alias("transactions_built"),
        F.count("land").alias("transactions_land"),
        F.avg("price").alias("price_mean"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        F.avg("price_m2").alias("price_m2_mean"),
        F.avg("built").alias("built_mean"),
        F.avg("land").alias("land_mean"),
        F.min("tx_date").alias("first_date"),
        F.max("tx_date").alias("last_date"),
    ]
    medians = {f"{name}_median": F.col(name) for name in ("price", "price_m2", "built", "land")}
    folded = aggregate_with_medians(sales, ["city_id"], totals, medians)
    areas = cities.select(
        "city_id", "name", "department_id", "region_id", (mercator_area("geometry") / 1e6).alias("km2")
    )
    return (
        areas.join(folded, "city_id")
        .withColumn(DENSITY, F.expr("try_divide(double(transactions), km2)"))
        .select("city_id", "name", "department_id", "region_id", *COUNTERS, *_rounded())
    )


def _rollup(children: DataFrame, key: str, counters: list) -> DataFrame:
    """Statistics of a parent level from its children's rounded rows."""
    n, built, land = COUNTERS
    totals = [
        *counters,
        *[F.sum(name).alias(name) for name in COUNTERS],
        weighted_mean("price_mean", n).alias("price_mean"),
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
        weighted_mean("price_m2_mean", built).alias("price_m2_mean"),
        weighted_mean("built_mean", built).alias("built_mean"),
        weighted_mean("land_mean", land).alias("land_mean"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        weighted_mean(DENSITY, n).alias(DENSITY),
    ]
    return aggregate_with_medians(children, [key], totals, {name: F.col(name) for name in MEDIANS})


def department_stats(departments: DataFrame, cities: DataFrame) -> DataFrame:
    """Weighted means and medians of medians over city statistics."""
    active = cities.where(F.col("transactions") > 0)
    stats = _rollup(active, "department_id", [F.count("city_id").alias("cities")])
    return (
        departments.select("department_id", "name", "region_id")
        .join(stats, "department_id")
        .select("department_id", "name", "region_id", "cities", *COUNTERS, *_rounded())
    )


def region_stats(regions: DataFrame, departments: DataFrame) -> DataFrame:
    """The same measures over department statistics."""
    active = departments.where(F.col("transactions") > 0)
    counters = [F.count("department_id").alias("departments"), F.sum("cities").alias("cities")]
    stats = _rollup(active, "region_id", counters)
    return (
        regions.select("region_id", "name")
        .join(stats, "region_id")
        .select("region_id", "name", "departments", "cities", *COUNTERS, *_rounded())
    )
