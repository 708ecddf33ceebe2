"""Property transactions: cleaning, visibility, views, points."""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions import geometry as G
from geoledger.functions.codes import date_text
from geoledger.functions.numbers import ratio
from geoledger.schemas import TRANSACTIONS, TRANSACTION_HEADER


def rename_header(raw: DataFrame, header: dict[str, str] = TRANSACTION_HEADER) -> DataFrame:
    """Keep and rename the columns of a raw file the model uses."""
    return raw.select(*[F.col(source).alias(name) for source, name in header.items()])


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows with position, transaction id and parcel id."""
    return df.dropna(subset=["lat", "lon", "tx_id", "parcel_id"])


def conform_transactions(df: DataFrame) -> DataFrame:
    """The 11 model columns with their types; unreadable values become null."""
    fields = [item.split() for item in TRANSACTIONS.split(", ")]
    return df.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in fields])


def with_point(df: DataFrame) -> DataFrame:
    return df.withColumn("point", G.point("lon", "lat"))


def positive_sales(df: DataFrame) -> DataFrame:
    """Sales that enter statistics, with areas and price per m² only where the area is positive."""
    return df.where("price > 0").selectExpr(
        "city_id",
        "tx_id",
        "tx_date",
        "price",
        "CASE WHEN built_area > 0 THEN price / built_area END AS price_m2",
        "CASE WHEN built_area > 0 THEN built_area END AS built",
        "CASE WHEN land_area > 0 THEN land_area END AS land",
    )


def mask_low_price(price: Column, floor: float = C.MIN_PRICE) -> Column:
    """Prices under the floor are unknown."""
    return F.when(price >= floor, price)


def visible_transactions(df: DataFrame, floor: float = C.MIN_PRICE) -> DataFrame:
    return df.where(F.col("price") >= floor)


def _quoted(codes: tuple[str, ...]) -> str:
    return ", ".join(f"'{code}'" for code in codes)


def expand_agglomeration(ids: DataFrame, table: dict[str, tuple[str, ...]] = C.AGGLOMERATIONS) -> DataFrame:
    """A big-city code becomes the codes of its districts, other codes stay."""
    cases = " ".join(f"WHEN '{parent}' THEN array({_quoted(children)})" for parent, children in table.items())
    return ids.select(F.expr(f"explode(CASE city_id {cases} ELSE array(city_id) END) AS city_id"))


def with_agglomeration_id(
    df: DataFrame, table: dict[str, tuple[str, ...]] = C.AGGLOMERATIONS, key: str = "city_id"
) -> DataFrame:
    """Parent city of a district as ``agglomeration_id``, the own id elsewhere."""
    cases = " ".join(f"WHEN {key} IN ({_quoted(children)}) THEN '{parent}'" for parent, children in table.items())
    return df.select("*", F.expr(f"CASE {cases} ELSE {key} END AS agglomeration_id"))


def transactions_of(df: DataFrame, ids: list[str] | DataFrame) -> DataFrame:
    """Transactions of some cities: a short list becomes an IN filter, a frame a semi join."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select("city_id"), "city_id", "left_semi")
    return df.where(F.col("city_id").isin([str(i) for i in ids]))


def transaction_view(df: DataFrame) -> DataFrame:
    """Visible sales for a table on screen, oldest first."""
    view = visible_transactions(df).select(
        date_text(F.col("tx_date")).alias("date"),
        F.col("price"),
        F.col("built_area").alias("building_area"),
        F.col("land_area"),
    )
    return view.orderBy("date", "price", "building_area", "land_area")


def points_within(df: DataFrame, view: G.Viewport) -> DataFrame:
    """Sales strictly inside the viewport; the comparisons reach the parquet scan."""
    return df.where(G.within_box("lon", "lat", G.viewport_box(view)))


def recent_transactions(df: DataFrame, view: G.Viewport, k: int = C.MAX_POINTS) -> DataFrame:
    """Latest visible sales in the viewport; plans as a per-task top-k, no global sort."""
    order = [F.desc("tx_date"), *[F.asc(c) for c in ("tx_id", "parcel_id", "price", "built_area", "land_area", "lon", "lat")]]
    return df.transform(visible_transactions).transform(points_within, view).orderBy(*order).limit(k)


def transaction_features(df: DataFrame) -> DataFrame:
    """Map features of sales: properties and GeoJSON point."""
    properties = F.struct(
        date_text(F.col("tx_date")).alias("date"),
        F.col("price"),
        F.col("built_area"),
        F.col("land_area"),
    )
    return df.select(
        F.lit("Feature").alias("type"),
        properties.alias("properties"),
        G.point_geojson("lon", "lat").alias("geometry"),
    )


#: Cells along the longer side of an area's box.
CELLS_PER_SIDE = 4


def spots_near_areas(spots: DataFrame, areas: DataFrame, cell: float | None = None) -> DataFrame:
    """Rows of ``spots`` (lon, lat, ...) with the ``area_id`` and box of the areas in whose cells they lie.

    Every area is covered by cells of its own size, sides of powers of two of about a quarter of its box, so a point meets about
    as many areas as have it near their box, however unlike in size they are and however crowded the place is.  A point is
    looked up once per level in use.  ``cell`` sets one side for all areas instead.  Columns ``outline`` and ``inner`` of the areas
    come along, of the outline in each cell the edges at the heights of the cell: no other edge decides on a point there.
    """
    own = {corner: corner for corner in G.CORNERS}
    level = F.expr(G.level_of_extent(own, CELLS_PER_SIDE)) if cell is None else F.lit(log2(cell))
    shape = [c for c in ("outline", "inner") if c in areas.columns]
    cover = areas.select("area_id", *G.CORNERS, *shape, level.alias("level")).where("level is not null and min_x is not null")
    levels = areas.select(level.alias("level"), "min_x").where("level is not null and min_x is not null")
    levels = levels.agg(F.array_sort(F.collect_set("level"))).scalar()
    cover = cover.select("*", F.inline(G.cells_at(own, "level")))
    if "outline" in shape:
        cover = cover.withColumn("outline", G.edges_in_band("outline", "pow(2D, level)", "j"))
    looked = spots.withColumn("level", F.explode(levels))
    looked = looked.selectExpr("*", "floor(lon / pow(2D, level)) AS i", "floor(lat / pow(2D, level)) AS j")
    return looked.join(cover, ["level", "i", "j"]).drop("level", "i", "j")


def points_in_areas(tx: DataFrame, areas: DataFrame, cell: float | None = None) -> DataFrame:
    """Count, mean price and mean areas of the sales strictly inside each area.

    Sales at the same position are folded first.  Positions and areas meet in cells sized by the areas (``spots_near_areas``);
    AQE splits a cell with most positions.  A box inside the area or else the edges of the cell decide, and the sales found are folded
    per area before they are shuffled: the pairs stay in their task.
    """
    spots = (
        tx.where(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        .groupBy("lon", "lat")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[
                agg
                for name in ("price", "built_area", "land_area")
                for agg in (F.sum(name).alias(name), F.count(name).alias(f"{name}_n"))
            ],
        )
    )
    outlines = areas.select("area_id", G.outline("geometry").alias("outline"), G.inner_box("geometry").alias("inner"))
    near = spots_near_areas(spots, areas.select("area_id", *G.CORNERS).join(outlines, "area_id"), cell)
    near = near.where(G.within_box("lon", "lat", {c: c for c in G.CORNERS}))
    settled = G.within_box("lon", "lat", {c: f"inner.{c}" for c in G.CORNERS})
    found = near.where(settled | G.outline_contains("outline", "lon", "lat"))

    def mean(name: str) -> Column:
        return ratio(F.sum(name), F.sum(f"{name}_n")).alias(f"{name}_mean")

    return found.groupBy("area_id").agg(
        F.sum("n").alias("transactions"), mean("price"), mean("built_area"), mean("land_area")
    )
