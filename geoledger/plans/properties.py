"""Registered queries on transactions and property statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.functions.codes import date_text
from geoledger.operators import areas as M
from geoledger.operators import quality as V
from geoledger.operators import rankings as K
from geoledger.functions.numbers import round_half_up
from geoledger.operators import transactions as P
from geoledger.operators.rollup import property_rollup
from geoledger.plans import inputs as I
from geoledger.sources import bindings as B
from geoledger.sources.scratch import scratch_path

DISTRICTS = {"90": ("91", "92", "93"), "80": ("81", "82")}



def a1_city_stats(spark: SparkSession, sf: str) -> DataFrame:
    return I.city_stats(spark, sf)


def a2_department_stats(spark: SparkSession, sf: str) -> DataFrame:
    return I.department_stats(spark, sf)


def a3_region_stats(spark: SparkSession, sf: str) -> DataFrame:
    return I.region_stats(spark, sf)


def a4_property_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """A first run with false prices in half of the cities, then the true sales of these laid over it."""
    areas = {"city": B.cities(spark, sf), "department": B.departments(spark, sf), "region": B.regions(spark, sf)}
    first, second = scratch_path(spark, "rollup"), scratch_path(spark, "rollup")
    half = F.col("city_id").cast("bigint") % 2 == 0
    sales = B.transactions(spark, sf)
    property_rollup(areas, sales.withColumn("price", F.when(half, F.col("price") * 3).otherwise(F.col("price"))), first)
    return property_rollup(areas, sales.where(half), second, previous=first)["region"].drop("extracted_at")


def a5_legend_bounds(spark: SparkSession, sf: str) -> DataFrame:
    rows = M.areas_with_stats(B.cities(spark, sf).drop("geometry"), I.city_stats(spark, sf), "city")
    return M.legend_bounds(rows.withColumn("price", P.mask_low_price(F.col("price"))))


def a6_area_listing(spark: SparkSession, sf: str) -> DataFrame:
    return M.area_listing(I.area_levels(spark, sf), ("Supplier#00000001",))


def j4_areas_with_stats(spark: SparkSession, sf: str) -> DataFrame:
    return M.areas_with_stats(B.cities(spark, sf), I.city_stats(spark, sf), "city").drop(
        "geometry", "min_x", "min_y", "max_x", "max_y"
    )


def p1_drop_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    return P.drop_incomplete(B.transactions(spark, sf))


def p2_conform_transactions(spark: SparkSession, sf: str) -> DataFrame:
    tx = B.transactions(spark, sf)
    raw = tx.select(*[F.col(c).cast("string").alias(c) for c in tx.columns]).withColumns(
        {"postal_code": F.lpad("city_id", 5, "0"), "city_name": F.concat(F.lit("Supplier "), "city_id")}
    )
    return P.conform_transactions(raw)


def p3_positive_sales(spark: SparkSession, sf: str) -> DataFrame:
    return P.positive_sales(B.transactions(spark, sf))


def p4_mask_low_price(spark: SparkSession, sf: str) -> DataFrame:
    stats = I.city_stats(spark, sf)
    return stats.select("city_id", P.mask_low_price(F.col("price_m2_mean")).alias("price"))


def p5_visible_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return P.visible_transactions(B.transactions(spark, sf))


def p6_transactions_of_cities(spark: SparkSession, sf: str) -> DataFrame:
    return P.transactions_of(B.transactions(spark, sf), ["3", "17", "42"])


def p7_agglomeration_transactions(spark: SparkSession, sf: str) -> DataFrame:
    cities = B.cities(spark, sf).where(F.col("department_id").isin("3", "7", "11", "20")).select("city_id")
    return P.transactions_of(B.transactions(spark, sf), P.expand_agglomeration(cities, DISTRICTS))


def p8_agglomeration_ids(spark: SparkSession, sf: str) -> DataFrame:
    return P.with_agglomeration_id(B.cities(spark, sf).select("city_id", "name"), DISTRICTS)


def p9_exclude_parents(spark: SparkSession, sf: str) -> DataFrame:
    return M.exclude_parents(B.cities(spark, sf), ("Supplier#000000007", "Supplier#000000011")).select("city_id", "name")


def p10_exclude_districts(spark: SparkSession, sf: str) -> DataFrame:
    return M.exclude_districts(B.cities(spark, sf), ("Supplier#00000001", "Supplier#00000003")).select("city_id", "name")


def p13_date_text(spark: SparkSession, sf: str) -> DataFrame:
    tx = B.transactions(spark, sf)
    return tx.select(
        "tx_id",
        "parcel_id",
        date_text(F.col("tx_date")).alias("date"),
        date_text(F.concat(F.col("tx_date").cast("string"), F.lit("T00:00:00"))).alias("date_from_text"),
    )


def p14_transaction_view(spark: SparkSession, sf: str) -> DataFrame:
    return P.transaction_view(P.transactions_of(B.transactions(spark, sf), ["5"]))


def p15_price_table(spark: SparkSession, sf: str) -> DataFrame:
    return M.price_table(M.areas_with_stats(B.cities(spark, sf).drop("geometry"), I.city_stats(spark, sf), "city"))


def j17_points_in_areas(spark: SparkSession, sf: str) -> DataFrame:
    areas = B.cities(spark, sf).withColumnRenamed("city_id", "area_id")
    found = P.points_in_areas(B.transactions(spark, sf), areas)
    rounded = [round_half_up(F.col(c), 2).alias(c) for c in found.columns if c.endswith("_mean")]
    return found.select("area_id", "transactions", *rounded)


def k1_recent_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return P.recent_transactions(B.transactions(spark, sf), I.DEPARTMENT_VIEW)


def k4_top_cities_by_sales(spark: SparkSession, sf: str) -> DataFrame:
    return K.top_cities(I.city_stats(spark, sf), "n")


def k5_top_cities_by_price(spark: SparkSession, sf: str) -> DataFrame:
    return K.top_cities(I.city_stats(spark, sf), "price")


def k6_top_departments(spark: SparkSession, sf: str) -> DataFrame:
    return K.top_departments(I.department_stats(spark, sf), B.departments(spark, sf))


def k7_regions_by_price(spark: SparkSession, sf: str) -> DataFrame:
    return K.regions_by_price(I.region_stats(spark, sf))


def k10_volume_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return K.volume_outliers(I.department_stats(spark, sf))


def k13_area_histogram(spark: SparkSession, sf: str) -> DataFrame:
    stats = I.stored_city_stats(spark, sf)
    return K.area_histogram(stats, "built_mean").withColumn("measure", F.lit("built")).unionByName(
        K.area_histogram(stats, "land_mean").withColumn("measure", F.lit("land"))
    )


def k16_choropleth(spark: SparkSession, sf: str) -> DataFrame:
    rows = M.areas_with_stats(B.cities(spark, sf).drop("geometry"), I.stored_city_stats(spark, sf), "city")
    priced = rows.withColumn("price", P.mask_low_price(F.col("price")))
    bounds = M.legend_bounds(priced)
    lo, hi = bounds.select("min_price").scalar(), bounds.select("max_price").scalar()
    return M.choropleth(priced, "price", lo, hi).select("area_id", "price", "hue", "lightness")


def k17_legend_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return M.legend_ticks(a5_legend_bounds(spark, sf))


def v6_rollup_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    """Against a stored department table that misses one sale per department of region 0."""
    stats = I.all_stats(spark, sf)
    drifted = stats["department"].withColumn(
        "transactions", F.col("transactions") - F.when(F.col("region_id") == "0", 1).otherwise(0)
    )
    return V.rollup_mismatches(stats["city"], drifted, "department").unionByName(
        V.rollup_mismatches(drifted, stats["region"], "region")
    )


def v7_price_sanity(spark: SparkSession, sf: str) -> DataFrame:
    return V.price_sanity(I.city_stats(spark, sf))


def v13_level_summary(spark: SparkSession, sf: str) -> DataFrame:
    return V.level_summary(I.all_stats(spark, sf))


QUERIES = {f.__name__: f for f in (
    a1_city_stats, a2_department_stats, a3_region_stats, a4_property_rollup, a5_legend_bounds, a6_area_listing, j4_areas_with_stats,
    p1_drop_incomplete, p2_conform_transactions, p3_positive_sales, p4_mask_low_price, p5_visible_transactions,
    p6_transactions_of_cities, p7_agglomeration_transactions, p8_agglomeration_ids, p9_exclude_parents,
    p10_exclude_districts, p13_date_text, p14_transaction_view, p15_price_table, j17_points_in_areas,
    k1_recent_transactions, k4_top_cities_by_sales, k5_top_cities_by_price, k6_top_departments, k7_regions_by_price,
    k10_volume_outliers, k13_area_histogram, k16_choropleth, k17_legend_ticks, v6_rollup_mismatches, v7_price_sanity,
    v13_level_summary,
)}
