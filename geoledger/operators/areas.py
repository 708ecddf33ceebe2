"""Areas with statistics: listings, map features, viewport queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions import geometry as G
from geoledger.functions.numbers import ratio, round_half_up
from geoledger.operators.transactions import mask_low_price, with_agglomeration_id


def _key(level: str) -> str:
    if level not in C.LEVELS:
        raise ValueError(f"unknown level: {level}")
    return f"{level}_id"


def areas_with_stats(areas: DataFrame, stats: DataFrame, level: str) -> DataFrame:
    """Every area of a level with its sales count and prices, nulls where it has no statistics."""
    key = _key(level)
    prices = stats.select(
        key,
        "transactions",
        F.col("price_min").alias("min_price"),
        F.col("price_max").alias("max_price"),
        F.col("price_m2_mean").alias("price"),
    )
    kept = [c for c in ("geometry", "min_x", "min_y", "max_x", "max_y") if c in areas.columns]
    return (
        areas.select(key, "name", *kept)
        .join(prices, key, "left")
        .withColumnRenamed(key, "area_id")
        .withColumn("level", F.lit(level))
    )


def exclude_parents(df: DataFrame, names: tuple[str, ...] = C.AGGLOMERATION_NAMES) -> DataFrame:
    """Cities shown by district disappear as a whole."""
    return df.where(~F.col("name").isin(*names))


def exclude_districts(df: DataFrame, prefixes: tuple[str, ...] = C.DISTRICT_PREFIXES) -> DataFrame:
    """Districts disappear, the whole city stays."""
    district = reduce(lambda a, b: a | b, [F.col("name").startswith(p) for p in prefixes])
    return df.where(~district)


def legend_bounds(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Smallest and largest known price, 0 when none is known."""
    zero = F.lit(0.0)
    return df.groupBy(*keys).agg(
        F.coalesce(F.min("price"), zero).alias("min_price"), F.coalesce(F.max("price"), zero).alias("max_price")
    )


def price_table(df: DataFrame) -> DataFrame:
    return df.select("area_id", "name", "price")


def _listed(areas: DataFrame, stats: DataFrame, level: str, prefixes: tuple[str, ...]) -> DataFrame:
    rows = areas_with_stats(areas.drop("geometry"), stats, level).withColumn("price", mask_low_price(F.col("price")))
    return exclude_districts(rows, prefixes) if level == "city" else rows


def area_listing(
    levels: dict[str, tuple[DataFrame, DataFrame]], prefixes: tuple[str, ...] = C.DISTRICT_PREFIXES
) -> DataFrame:
    """Items of all levels with the level's title and price bounds; an empty level fails the query.

    One row per item: a list as long as the table is never folded into one document.
    """
    rows = reduce(
        DataFrame.unionByName,
        [price_table(_listed(a, s, level, prefixes)).withColumn("level", F.lit(level)) for level, (a, s) in levels.items()],
    )
    bounds = legend_bounds(rows, ("level",))
    titles = F.create_map(*[F.lit(x) for level in levels for x in (level, C.LEVEL_TITLES[level])])
    present = F.sort_array(F.collect_set("level"))
    missing = F.when(present == F.lit(sorted(levels)), F.lit(True)).otherwise(
        F.raise_error(F.lit("a level has no areas"))
    )
    complete = bounds.agg(missing.alias("ok")).scalar()
    return (
        rows.join(F.broadcast(bounds), "level")  # one row per level
        .where(complete)
        .select("level", titles[F.col("level")].alias("title"), "area_id", "name", "price", "min_price", "max_price")
    )


# --- map ----------------------------------------------------------------------------------------


def intersecting(areas: DataFrame, view: G.Viewport) -> DataFrame:
    """Areas that touch the viewport: bounding boxes at the scan, then the exact test."""
    box = G.viewport_box(view)
    return areas.where(G.overlaps_box(box)).where(G.intersects_box("geometry", box))


#: Tasks that share the viewports of a cell.
SLICES = 8
#: Tasks per core that cells are dealt to.
TASKS_PER_CORE = 16


def intersecting_many(areas: DataFrame, viewports: DataFrame, key: str = "city_id") -> DataFrame:
    """(view_id, area) pairs for a table of viewports, met in grid cells and then tested exactly.

    Cells come in sides of powers of two.  An area or viewport lies in at most four cells as large as itself, and it is entered there
    and at every coarser level in use; a pair meets at the level of the larger of the two, in the first cell both cover.  So
    neither a few large areas nor many small ones make long lists, and the viewports of a cell are dealt to several tasks.

    An area takes along a box that lies inside it (``G.inner_box``): a viewport that meets this box meets the area, and the pair is
    ready.  Only the other pairs whose boxes meet are joined with geometry, by the areas' unique ``key``; an area that fills its
    bounding box has none.  The pairs are many times the rows that meet.  So the cells are dealt to a number of tasks that does not go
    by bytes, and what can be told of a row in its cell is told before the pairs are made.
    """
    spark = areas.sparkSession
    sides = {"min_x": "sw_lon", "min_y": "sw_lat", "max_x": "ne_lon", "max_y": "ne_lat"}
    box = {corner: f"view_{corner}" for corner in G.CORNERS}
    own = {corner: corner for corner in G.CORNERS}
    views = viewports.select(
        "view_id",
        *[F.col(sides[corner]).alias(name) for corner, name in box.items()],
        F.pmod(F.xxhash64("view_id"), F.lit(SLICES)).alias("slice"),
    ).withColumn("view_level", F.expr(G.level_of_extent(box)))
    carried = [F.col(name).alias(f"_{name}") for name in areas.columns]
    boxes = areas.select(*carried, *G.CORNERS, F.expr(G.level_of_extent(own)).alias("area_level"), G.inner_box("geometry").alias("inner"))
    alone = F.count(f"_{key}").over(W.partitionBy(f"_{key}")) == 1
    boxes = boxes.withColumn("inner", F.when(alone, F.col("inner")))  # a repeated key is left to the join by key
    # the part of it in the bounding box: a viewport that meets this part meets both
    part = {corner: f"{'greatest' if 'min' in corner else 'least'}(inner.{corner}, {corner})" for corner in G.CORNERS}
    known = f"inner IS NOT NULL AND {part['min_x']} <= {part['max_x']} AND {part['min_y']} <= {part['max_y']}"
    boxes = boxes.select("*", *[F.expr(f"CASE WHEN {known} THEN {text} END").alias(f"inner_{corner}") for corner, text in part.items()])
    fills = F.expr(" AND ".join(f"inner_{corner} <=> {corner}" for corner in G.CORNERS))
    levels = areas.select(F.expr(G.level_of_extent(own)).alias("top"))
    top = views.select(F.col("view_level").alias("top")).unionByName(levels).agg(F.max("top")).scalar()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)

    def entered(rows: DataFrame, who: str, corners: G.Box) -> DataFrame:
        """Rows in their cells with a code of bits: the level is the row's own, the cell is in its first column, in its first row."""
        at_levels = rows.withColumn("top", top).withColumn("level", F.explode(F.expr(f"sequence({who}_level, top)"))).drop("top")
        steps = [f"{axis} - floor({corners[f'min_{axis_of}']} / pow(2D, level))" for axis, axis_of in (("i", "x"), ("j", "y"))]
        cells = at_levels.select("*", F.inline(G.cells_at(corners, "level"))).where(" AND ".join(f"{step} >= 0" for step in steps))
        bits = [f"level = {who}_level", *[f"{step} = 0" for step in steps]]
        return cells.withColumn(f"{who}_code", F.expr(" + ".join(f"if({bit}, {2**k}, 0)" for k, bit in enumerate(bits))))

    def met(views: DataFrame, boxes: DataFrame) -> DataFrame:
        """Viewports and areas in a cell of the level of the larger one, the first cell both cover."""
        view_cells = entered(views.where("view_level is not null"), "view", box)
        area_cells = entered(boxes.where("area_level is not null"), "area", own)
        area_cells = area_cells.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SLICES - 1).cast("bigint"))))
        at = ["level", "i", "j", "slice"]
        pairs = view_cells.repartition(tasks, *at).hint("merge").join(area_cells.repartition(tasks, *at), at)
        return pairs.where("(view_code | area_code) = 7")

    upright = F.expr("coalesce(view_min_x <= view_max_x AND view_min_y <= view_max_y, false)")
    sure = F.coalesce(G.overlaps_box(box, "inner_"), F.lit(False))
    others = [name for name in areas.columns if name != key]
    ready = met(views.where(upright), boxes.where("inner_min_x is not null")).where(G.overlaps_box(box, "inner_"))
    ready = ready.select(F.col(f"_{key}").alias(key), "view_id", *[F.col(f"_{name}").alias(name) for name in others])
    left = met(views.where(upright), boxes.where(~fills)).where(~sure).unionByName(met(views.where(~upright), boxes))
    view = F.struct(*[F.col(name).alias(corner) for corner, name in box.items()]).alias("view")
    open_pairs = left.where(G.overlaps_box(box)).select("view_id", view, F.col(f"_{key}").alias(key)).join(areas, key)
    return ready.unionByName(open_pairs.where(G.intersects_box("geometry", {corner: f"view.{corner}" for corner in G.CORNERS})).drop("view"))


def with_satisfaction(features: DataFrame, cities: DataFrame) -> DataFrame:
    """Mean rating of cities that have reviews, null elsewhere."""
    rated = cities.where(F.col("review_count") > 0).select(
        F.col("city_id").alias("area_id"), F.col("scores.mean").alias("satisfaction")
    )
    return features.join(rated, "area_id", "left")


def map_features(
    areas: DataFrame,
    stats: DataFrame,
    level: str,
    cities: DataFrame,
    excluded: tuple[str, ...] = C.AGGLOMERATION_NAMES,
    table: dict[str, tuple[str, ...]] = C.AGGLOMERATIONS,
) -> DataFrame:
    """Rows of the price map: masked price, bounds, satisfaction, parent city and detail links."""
    rows = areas_with_stats(areas, stats, level).withColumn("price", mask_low_price(F.col("price")))
    if level == "city":
        rows = exclude_parents(rows, excluded)
        rows = with_satisfaction(with_agglomeration_id(rows, table, "area_id"), cities)
    else:
        rows = rows.selectExpr("*", "area_id AS agglomeration_id", "double(NULL) AS satisfaction")
    return rows.selectExpr(
        "level",
        "area_id",
        "agglomeration_id",
        "name",
        "price",
        "max_price",
        "min_price",
        "satisfaction",
        f"concat('api/v1/word-clouds/{C.LEVEL_PATHS[level]}/', agglomeration_id) AS word_cloud_url",
        f"concat('api/v1/sentiments/{C.LEVEL_PATHS[level]}/', agglomeration_id) AS sentiments_url",
        "geometry",
    )


def level_of(view: G.Viewport) -> str:
    """Level a viewport starts from."""
    if view.zoom <= C.REGION_ZOOM:
        return "region"
    return "department" if view.zoom <= C.DEPARTMENT_ZOOM else "city"


def level_in_view(
    levels: dict[str, tuple[DataFrame, DataFrame]],
    view: G.Viewport,
    limit: int = C.MAX_FEATURES,
    level: str | None = None,
    excluded: tuple[str, ...] = C.AGGLOMERATION_NAMES,
) -> str:
    """Finest level from ``level`` (the zoom's own level) up with fewer than ``limit`` areas in view.

    A level is counted up to ``limit`` rows and no further; the coarsest one is not counted.
    """
    start = level or level_of(view)
    _key(start)
    for name in C.LEVELS[C.LEVELS.index(start) : -1]:
        seen = intersecting(levels[name][0], view)
        counted = exclude_parents(seen, excluded) if name == "city" else seen
        if counted.limit(limit).count() < limit:
            return name
    return C.LEVELS[-1]


def areas_in_viewport(
    levels: dict[str, tuple[DataFrame, DataFrame]],
    cities: DataFrame,
    view: G.Viewport,
    limit: int = C.MAX_FEATURES,
    level: str | None = None,
    excluded: tuple[str, ...] = C.AGGLOMERATION_NAMES,
) -> DataFrame:
    """Map rows of the level that fits the viewport (``level_in_view``), a lazy plan over that level."""
    name = level_in_view(levels, view, limit, level, excluded)
    areas, stats = levels[name]
    return map_features(intersecting(areas, view), stats, name, cities, excluded)


def viewport_document(
    levels: dict[str, tuple[DataFrame, DataFrame]], cities: DataFrame, view: G.Viewport, limit: int = C.MAX_FEATURES
) -> DataFrame:
    """The map rows of a viewport as one FeatureCollection document, also when no area is in view."""
    name = level_in_view(levels, view, limit)
    areas, stats = levels[name]
    return feature_collection(map_features(intersecting(areas, view), stats, name, cities), name)


def _feature_text(properties: Column, geometry: Column) -> Column:
    return F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(properties, {"ignoreNullFields": "false"}),
        F.lit(',"geometry":'),
        geometry,
        F.lit("}"),
    )


def feature_collection(rows: DataFrame, level: str) -> DataFrame:
    """One FeatureCollection document per query, with name and price bounds.

    A document is for a screen and holds all rows given; ``rows`` themselves are the form for whole territories.
    """
    properties = F.struct(
        F.col("area_id").alias("id"), "agglomeration_id", "name", "price", "max_price", "min_price",
        "satisfaction", "word_cloud_url", "sentiments_url",
    )
    items = rows.withColumn(
        "_feature", _feature_text(properties, G.to_geojson("geometry"))
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("area_id", "_feature"))), lambda f: f["_feature"])
    metadata = F.to_json(
        F.struct(
            F.lit(C.LEVEL_TITLES[level]).alias("name"),
            F.coalesce(F.min("price"), F.lit(0.0)).alias("min_price"),
            F.coalesce(F.max("price"), F.lit(0.0)).alias("max_price"),
            F.lit(True).alias("show"),
        )
    )
    document = F.concat(
        F.lit('{"type":"FeatureCollection","features":['), F.array_join(ordered, ","), F.lit('],"metadata":'), metadata, F.lit("}")
    )
    return items.agg(document.alias("document"))


def transaction_collection(features: DataFrame) -> DataFrame:
    """One FeatureCollection document of sale points."""
    item = _feature_text(F.col("properties"), F.col("geometry"))
    body = F.array_join(F.array_sort(F.collect_list(item)), ",")
    document = F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}"))
    return features.agg(document.alias("document"))


# --- colours ------------------------------------------------------------------------------------


def choropleth(df: DataFrame, col: str, lo: Column, hi: Column) -> DataFrame:
    """Hue and lightness of a value on the scale ``lo`` to ``hi`` (which may run downwards)."""
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio(F.col(col) - lo, hi - lo)))
    known = F.col(col).isNotNull() & ~F.isnan(F.col(col)) & (hi != lo)
    hue = round_half_up((1 - share) * 180, 4)
    lightness = round_half_up(F.lit(20) + share * 40, 4)
    text = F.concat(F.lit("hsl("), hue.cast("string"), F.lit(", 100%, "), lightness.cast("string"), F.lit("%)"))
    return df.withColumns(
        {
            "hue": F.when(known, hue),
            "lightness": F.when(known, lightness),
            "colour": F.when(known, text).otherwise(F.lit(C.NEUTRAL_COLOUR)),
        }
    )


def satisfaction_colours(df: DataFrame, col: str = "satisfaction") -> DataFrame:
    lo, hi = C.SATISFACTION_SCALE
    return choropleth(df, col, F.lit(lo), F.lit(hi))


def legend_ticks(bounds: DataFrame) -> DataFrame:
    """Rounded lower end, middle and upper end of a price scale."""
    lo, hi = F.col("min_price"), F.col("max_price")
    return bounds.select(
        *[
            F.floor(value + 0.5).cast("bigint").alias(name)
            for name, value in (("low", lo), ("middle", (lo + hi) / 2), ("high", hi))
        ]
    )
