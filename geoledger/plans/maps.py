"""Registered queries on geometry, viewports and map documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions import geometry as G
from geoledger.functions.codes import level_for_zoom
from geoledger.functions.numbers import round_half_up
from geoledger.operators import areas as M
from geoledger.operators import reviews as R
from geoledger.operators import transactions as P
from geoledger.operators.validity import rebuild_crossing
from geoledger.plans import inputs as I
from geoledger.sources import bindings as B
from geoledger.sources.scratch import materialise


def viewports(spark: SparkSession, sf: str) -> DataFrame:
    """One map window per customer."""
    key = F.col("c_custkey")
    west, south = F.lit(-5) + (key % 140).cast("double") / 10, F.lit(42) + (key % 80).cast("double") / 10
    return B.table(spark, sf, "customer").select(
        key.alias("view_id"),
        (key % 15 + 1).cast("int").alias("zoom"),
        south.alias("sw_lat"),
        west.alias("sw_lon"),
        (south + 0.5).alias("ne_lat"),
        (west + 0.5).alias("ne_lon"),
    )


def _flat(rows: DataFrame) -> DataFrame:
    return rows.withColumn("polygons", F.size("geometry")).drop("geometry")


def _wkt(areas: DataFrame) -> DataFrame:
    return areas.select("city_id", G.to_wkt("geometry").alias("wkt"))


def g1_parse_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """Multipolygon text, every third city with its points as quoted text."""
    text = G.coordinates_json("geometry")
    quoted = F.regexp_replace(text, r"\[(-?[0-9.]+,-?[0-9.]+)\]", '"[$1]"')
    mixed = F.when(F.col("city_id").cast("bigint") % 3 == 0, quoted).otherwise(text)
    return _wkt(B.cities(spark, sf).withColumn("text", mixed).withColumn("geometry", G.parse_coordinates("text", "'MultiPolygon'")))


def g2_as_multipolygon(spark: SparkSession, sf: str) -> DataFrame:
    return _wkt(B.cities(spark, sf).withColumn("geometry", G.as_multipolygon("geometry[0]")))


def g3_repair_rings(spark: SparkSession, sf: str) -> DataFrame:
    """Squares whose ring repeats a point and stays open, next to a degenerate ring; every seventh crosses itself."""
    ring = F.get(F.get("geometry", F.lit(0)), F.lit(0))
    first, rest = F.slice(ring, 1, 1), F.slice(ring, 2, 3)
    broken = F.array(F.array(F.concat(first, first, rest), F.slice(ring, 1, 2)))
    twisted = F.concat(first, F.slice(ring, 3, 1), F.slice(ring, 2, 1), F.slice(ring, 4, 1), first)
    shape = F.when(F.col("city_id").cast("bigint") % 7 == 0, F.array(F.array(twisted))).otherwise(broken)
    areas = B.cities(spark, sf).withColumn("geometry", shape).withColumn("geometry", G.repair_rings("geometry"))
    areas = materialise(rebuild_crossing(areas.select("city_id", "geometry")), "rebuilt")
    return areas.select("city_id", G.to_wkt("geometry").alias("wkt"), G.is_simple("geometry").alias("simple"), "repaired")


def g4_to_wkt(spark: SparkSession, sf: str) -> DataFrame:
    return _wkt(B.cities(spark, sf))


def g5_from_wkt(spark: SparkSession, sf: str) -> DataFrame:
    texts = B.cities(spark, sf).select("city_id", G.to_wkt("geometry").alias("wkt"))
    return texts.select("city_id", G.from_wkt("wkt").alias("geometry")).transform(G.with_bbox).drop("geometry")


def g6_point(spark: SparkSession, sf: str) -> DataFrame:
    tx = P.with_point(B.transactions(spark, sf))
    return tx.select("tx_id", "parcel_id", F.col("point.x").alias("x"), F.col("point.y").alias("y"))


def g7_to_geojson(spark: SparkSession, sf: str) -> DataFrame:
    return B.cities(spark, sf).select("city_id", G.to_geojson("geometry").alias("geojson"))


def g8_mercator_area(spark: SparkSession, sf: str) -> DataFrame:
    return B.cities(spark, sf).select("city_id", round_half_up(G.mercator_area("geometry") / 1e6, 4).alias("km2"))


def g9_intersects_box(spark: SparkSession, sf: str) -> DataFrame:
    hit = G.intersects_box("geometry", G.viewport_box(I.DEPARTMENT_VIEW))
    return B.cities(spark, sf).select("city_id", hit.alias("intersects"))


def g10_within_box(spark: SparkSession, sf: str) -> DataFrame:
    inside = G.within_box("lon", "lat", G.viewport_box(I.CITY_VIEW))
    return B.transactions(spark, sf).groupBy("city_id").agg(
        F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside")
    )


def g11_box_and_cell(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with their number of sales."""
    points = B.transactions(spark, sf).where(F.col("lon").isNotNull()).transform(G.with_cell, 0.5)
    return points.groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"))


def g12_map_features(spark: SparkSession, sf: str) -> DataFrame:
    excluded = ("Supplier#000000007",)
    rows = M.map_features(
        B.cities(spark, sf), I.city_stats(spark, sf), "city", B.city_documents(spark, sf), excluded,
        {"90": ("91", "92", "93"), "80": ("81", "82")},
    )
    return rows.withColumn("geometry", G.to_wkt("geometry"))


def g13_transaction_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.transaction_features(P.recent_transactions(B.transactions(spark, sf), I.CITY_VIEW))
    return rows.select("type", "properties.*", "geometry")


def j5_with_satisfaction(spark: SparkSession, sf: str) -> DataFrame:
    areas = B.cities(spark, sf).select(F.col("city_id").alias("area_id"), "name")
    return M.with_satisfaction(areas, B.city_documents(spark, sf))


def j6_area_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names while the reference table lacks the departments of one region."""
    known = B.departments(spark, sf).where(F.col("region_id") != "0")
    rows = R.department_reviews(B.city_documents(spark, sf)).select("department_id", "cities")
    return R.with_area_names(rows, known, "department_id", C.DEPARTMENT_LABEL)


def j13_areas_in_view(spark: SparkSession, sf: str) -> DataFrame:
    return M.intersecting(B.cities(spark, sf), I.CITY_VIEW).select("city_id", "name")


def j13_areas_of_viewports(spark: SparkSession, sf: str) -> DataFrame:
    return M.intersecting_many(B.cities(spark, sf), viewports(spark, sf)).select("view_id", "city_id")


def j14_points_within(spark: SparkSession, sf: str) -> DataFrame:
    return P.points_within(B.transactions(spark, sf), I.DEPARTMENT_VIEW)


def p11_level_for_zoom(spark: SparkSession, sf: str) -> DataFrame:
    return viewports(spark, sf).select("view_id", "zoom", level_for_zoom(F.col("zoom")).alias("level"))


def _in_view(spark: SparkSession, sf: str, view: G.Viewport, limit: int = C.MAX_FEATURES) -> DataFrame:
    return _flat(M.areas_in_viewport(I.area_levels(spark, sf), B.city_documents(spark, sf), view, limit))


def p12_region_view(spark: SparkSession, sf: str) -> DataFrame:
    return _in_view(spark, sf, I.REGION_VIEW)


def p12_department_view(spark: SparkSession, sf: str) -> DataFrame:
    return _in_view(spark, sf, I.DEPARTMENT_VIEW)


def p12_city_view(spark: SparkSession, sf: str) -> DataFrame:
    return _in_view(spark, sf, I.CITY_VIEW)


def p12_fallback_view(spark: SparkSession, sf: str) -> DataFrame:
    """Whole territory at city zoom: more areas than allowed, so a coarser level answers."""
    return _in_view(spark, sf, G.Viewport(12, 41, -6, 52, 10), limit=30)


def s10_feature_collection(spark: SparkSession, sf: str) -> DataFrame:
    return M.viewport_document(I.area_levels(spark, sf), B.city_documents(spark, sf), I.CITY_VIEW)


def s10_transaction_collection(spark: SparkSession, sf: str) -> DataFrame:
    latest = P.recent_transactions(B.transactions(spark, sf), I.CITY_VIEW)
    return M.transaction_collection(P.transaction_features(latest))


def k16_satisfaction_colours(spark: SparkSession, sf: str) -> DataFrame:
    rows = M.satisfaction_colours(j5_with_satisfaction(spark, sf))
    return rows.select("area_id", "satisfaction", "hue", "lightness", "colour")


QUERIES = {f.__name__: f for f in (
    g1_parse_coordinates, g2_as_multipolygon, g3_repair_rings, g4_to_wkt, g5_from_wkt, g6_point, g7_to_geojson,
    g8_mercator_area, g9_intersects_box, g10_within_box, g11_box_and_cell, g12_map_features, g13_transaction_features,
    j5_with_satisfaction, j6_area_names, j13_areas_in_view, j13_areas_of_viewports, j14_points_within,
    p11_level_for_zoom, p12_region_view, p12_department_view, p12_city_view, p12_fallback_view,
    s10_feature_collection, s10_transaction_collection, k16_satisfaction_colours,
)}
