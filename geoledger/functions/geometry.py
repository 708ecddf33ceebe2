"""Multipolygon arithmetic with SQL array expressions; nothing leaves the JVM.

A geometry is ``array<polygon>``, a polygon ``array<ring>`` (outer ring first, then holes), a ring
``array<struct<x, y>>`` with its first point repeated at the end.  Arguments are column names or SQL
expressions.  An array that is used several times is bound as a lambda variable, so that it is
computed once per row and not once per point.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.schemas import GEOMETRY

CORNERS = ("min_x", "min_y", "max_x", "max_y")


@dataclass(frozen=True)
class Viewport:
    """Map window: zoom, south-west corner, north-east corner."""

    zoom: int
    sw_lat: float
    sw_lon: float
    ne_lat: float
    ne_lon: float


Box = dict[str, str]  # CORNERS -> SQL expression


def viewport_box(view: Viewport) -> Box:
    sides = (view.sw_lon, view.sw_lat, view.ne_lon, view.ne_lat)
    return {corner: f"{float(side)!r}D" for corner, side in zip(CORNERS, sides)}


# --- reading and writing ------------------------------------------------------------------------


def _points(nested: str) -> str:
    """array<array<array<array<double>>>> -> GEOMETRY, extra ordinates dropped."""
    pair = "named_struct('x', p[0], 'y', p[1])"
    return f"transform({nested}, g -> transform(g, r -> transform(r, p -> {pair})))"


def parse_coordinates(coordinates: str, kind: str) -> Column:
    """GeoJSON coordinate text of a Polygon or MultiPolygon as a multipolygon.

    Points that arrive as quoted text (``"[2.1,48.8]"``) are accepted.
    """
    text = f"replace({coordinates}, '\"', '')"
    nested = f"CASE {kind} WHEN 'Polygon' THEN concat('[', {text}, ']') WHEN 'MultiPolygon' THEN {text} END"
    return F.expr(_points(f"from_json({nested}, 'array<array<array<array<double>>>>')"))


def as_multipolygon(polygon: str) -> Column:
    return F.expr(f"CASE WHEN {polygon} IS NOT NULL THEN array({polygon}) END")


def repair_rings(geometry: str) -> Column:
    """Drop repeated neighbours, close open rings, drop rings under four points and empty polygons."""
    distinct = "filter(r, (p, i) -> i = 0 OR p != r[i - 1])"
    closed = "CASE WHEN size(c) > 0 AND c[0] != element_at(c, -1) THEN concat(c, slice(c, 1, 1)) ELSE c END"
    rings = f"transform(transform({geometry}, g -> transform(g, r -> {distinct})), g -> transform(g, c -> {closed}))"
    kept = "CASE WHEN size(get(g, 0)) >= 4 THEN filter(g, r -> size(r) >= 4) ELSE slice(g, 1, 0) END"
    return F.expr(f"filter(transform({rings}, g -> {kept}), g -> size(g) > 0)")


def _side(edge: str, x: str, y: str) -> str:
    """Which side of an edge a point lies on: -1, 0, 1."""
    return f"signum(({edge}.x2 - {edge}.x1) * ({y} - {edge}.y1) - ({edge}.y2 - {edge}.y1) * ({x} - {edge}.x1))"


def is_simple(geometry: str) -> Column:
    """No two edges of a ring cross; rings that do are reported, not repaired.

    Every pair of edges of a ring is looked at: meant for checking boundaries once, at import.
    """
    apart = f"{_side('a', 'b.x1', 'b.y1')} * {_side('a', 'b.x2', 'b.y2')} < 0"
    across = f"{_side('b', 'a.x1', 'a.y1')} * {_side('b', 'a.x2', 'a.y2')} < 0"
    crossing = f"exists(es, a -> exists(es, b -> {apart} AND {across}))"
    return F.expr(f"NOT exists({geometry}, g -> exists(transform(g, r -> {_edges('r')}), es -> {crossing}))")


def _nested_text(items: str, var: str, body: str) -> str:
    return f"concat('(', array_join(transform({items}, {var} -> {body}), ', '), ')')"


def to_wkt(geometry: str) -> Column:
    number = lambda n: f"regexp_replace(string({n}), '[.]0$', '')"
    pair = f"concat({number('p.x')}, ' ', {number('p.y')})"
    body = _nested_text(geometry, "g", _nested_text("g", "r", _nested_text("r", "p", pair)))
    return F.expr(f"concat('MULTIPOLYGON ', {body})")


def from_wkt(text: str) -> Column:
    number = "(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    body = f"regexp_replace({text}, '(?i)^ *MULTIPOLYGON *', '')"
    pairs = f"regexp_replace({body}, '{number} +{number}', '[$1,$2]')"
    return F.expr(_points(f"from_json(translate({pairs}, '()', '[]'), 'array<array<array<array<double>>>>')"))


def point(lon: str, lat: str) -> Column:
    """Point in longitude / latitude degrees (SRID 4326), null when a coordinate is missing."""
    return F.expr(f"CASE WHEN {lon} IS NOT NULL AND {lat} IS NOT NULL THEN named_struct('x', {lon}, 'y', {lat}) END")


def coordinates_json(geometry: str) -> Column:
    """Coordinate array of a MultiPolygon as GeoJSON text."""
    nested = f"transform({geometry}, g -> transform(g, r -> transform(r, p -> array(p.x, p.y))))"
    return F.expr(f"to_json({nested})")


def to_geojson(geometry: str) -> Column:
    return F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), coordinates_json(geometry), F.lit("}"))


def point_geojson(lon: str, lat: str) -> Column:
    return F.expr(f"to_json(named_struct('type', 'Point', 'coordinates', array({lon}, {lat})))")


# --- measures -----------------------------------------------------------------------------------


def _edges(ring: str) -> str:
    """Neighbouring points of a ring as (x1, y1, x2, y2)."""
    n = f"greatest(size({ring}) - 1, 0)"
    pair = "named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y)"
    return f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), (a, b) -> {pair})"


def _ring_area(ring: str) -> str:
    """Unsigned shoelace area, measured from the first point to keep the terms small."""
    x, y = f"get({ring}, 0).x", f"get({ring}, 0).y"
    term = f"(e.x1 - {x}) * (e.y2 - {y}) - (e.x2 - {x}) * (e.y1 - {y})"
    return f"abs(aggregate({_edges(ring)}, 0D, (total, e) -> total + {term})) / 2"


def ring_area(ring: str) -> Column:
    return F.expr(_ring_area(ring))


def mercator_area(geometry: str) -> Column:
    """Area in m² on the EPSG:3857 plane (inflated by 1/cos² of latitude): outer rings minus holes."""
    x = f"{C.EARTH_RADIUS!r}D * radians(p.x)"
    y = f"{C.EARTH_RADIUS!r}D * ln(tan(pi() / 4 + radians(p.y) / 2))"
    plane = f"transform({geometry}, g -> transform(g, r -> transform(r, p -> named_struct('x', {x}, 'y', {y}))))"
    areas = f"transform({plane}, g -> transform(g, r -> {_ring_area('r')}))"
    polygon = "2 * get(s, 0) - aggregate(s, 0D, (total, ring) -> total + ring)"
    return F.expr(f"aggregate({areas}, 0D, (whole, s) -> whole + {polygon})")


def _bbox(geometry: str) -> str:
    points = f"flatten(flatten({geometry}))"
    sides = [f"'{side}_{axis}', array_{side}(transform({points}, p -> p.{axis}))" for side in ("min", "max") for axis in "xy"]
    return f"named_struct({', '.join(sides)})"


def bbox(geometry: str) -> Column:
    """Struct min_x, min_y, max_x, max_y."""
    return F.expr(_bbox(geometry))


def with_bbox(areas: DataFrame) -> DataFrame:
    """Bounding-box columns next to the geometry: parquet min/max statistics make them an index."""
    return areas.withColumn("_box", bbox("geometry")).select("*", "_box.*").drop("_box")


# --- predicates ---------------------------------------------------------------------------------


def within_box(lon: str, lat: str, box: Box) -> Column:
    """Strictly inside: a point on the border is outside."""
    return F.expr(
        f"{lon} > {box['min_x']} AND {lon} < {box['max_x']} AND {lat} > {box['min_y']} AND {lat} < {box['max_y']}"
    )


def _overlaps(one: Box, box: Box) -> str:
    return (
        f"({one['min_x']} <= {box['max_x']} AND {one['max_x']} >= {box['min_x']}"
        f" AND {one['min_y']} <= {box['max_y']} AND {one['max_y']} >= {box['min_y']})"
    )


def overlaps_box(box: Box, prefix: str = "") -> Column:
    """The bounding-box columns of an area meet a box, borders included."""
    return F.expr(_overlaps({corner: prefix + corner for corner in CORNERS}, box))


def _edge_meets_box(box: Box) -> str:
    sides = ", ".join(_side("e", box[x], box[y]) for x in ("min_x", "max_x") for y in ("min_y", "max_y"))
    extent = {
        f"{side}_{axis}": f"{pick}(e.{axis}1, e.{axis}2)"
        for side, pick in (("min", "least"), ("max", "greatest"))
        for axis in "xy"
    }
    return f"({_overlaps(extent, box)} AND least({sides}) <= 0 AND greatest({sides}) >= 0)"


def _covers(edges: str, x: str, y: str) -> str:
    """Even-odd test of a point against all rings of one polygon: edges met by the ray to the right."""
    meets = f"(e.y1 > {y}) != (e.y2 > {y}) AND {x} < (e.x2 - e.x1) * try_divide({y} - e.y1, e.y2 - e.y1) + e.x1"
    return f"size(filter({edges}, e -> {meets})) % 2 = 1"


def _on_border(edges: str, x: str, y: str) -> str:
    on_line = f"(e.x2 - e.x1) * ({y} - e.y1) = (e.y2 - e.y1) * ({x} - e.x1)"
    near = f"{x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND {y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"
    return f"exists({edges}, e -> {on_line} AND {near})"


def outline(geometry: str) -> Column:
    """Edges of each polygon, all rings together."""
    return F.expr(_outline(geometry))


def _outline(geometry: str) -> str:
    return f"transform({geometry}, g -> flatten(transform(g, r -> {_edges('r')})))"


def edges_in_band(edges: str, side: str, band: str) -> Column:
    """The edges of an outline that reach the heights y with floor(y / side) = band."""
    at = lambda pick: f"floor({pick}(e.y1, e.y2) / {side})"
    odd = "e.y1 IS NULL OR e.y2 IS NULL OR isnan(e.y1) OR isnan(e.y2)"
    return F.expr(f"transform({edges}, es -> filter(es, e -> {odd} OR ({at('greatest')} >= {band} AND {at('least')} <= {band})))")


def outline_contains(edges: str, x: str, y: str) -> Column:
    """Point strictly inside one of the polygons of an outline; the border is outside."""
    return F.expr(f"exists({edges}, es -> {_covers('es', x, y)} AND NOT {_on_border('es', x, y)})")


def contains_point(geometry: str, x: str, y: str) -> Column:
    return outline_contains(_outline(geometry), x, y)


def intersects_box(geometry: str, box: Box) -> Column:
    """Area and box share at least one point, borders included."""
    inside = _covers("es", box["min_x"], box["min_y"])
    return F.expr(f"exists({_outline(geometry)}, es -> exists(es, e -> {_edge_meets_box(box)}) OR {inside})")


def inner_box(geometry: str, shares: tuple[float, ...] = (1.0, 0.75, 0.5, 0.25)) -> Column:
    """A box inside one polygon, the first found of boxes around the centre of the bounding box; null if none is found.

    No edge enters the open box, and its centre is covered.  What meets the box meets the area.
    """

    def around(share: float) -> str:
        near, far = (1 - share) / 2, (1 + share) / 2
        at = lambda axis, part: f"b.min_{axis} + (b.max_{axis} - b.min_{axis}) * {part!r}D" if part < 1 else f"b.max_{axis}"
        sides = [f"'{side}_{axis}', {at(axis, part)}" for side, part in (("min", near), ("max", far)) for axis in "xy"]
        return f"named_struct({', '.join(sides)})"

    enters = (
        "greatest(e.x1, e.x2) > r.min_x AND least(e.x1, e.x2) < r.max_x AND greatest(e.y1, e.y2) > r.min_y AND least(e.y1, e.y2) < r.max_y"
    )
    middle = _covers("es", "((r.min_x + r.max_x) / 2)", "((r.min_y + r.max_y) / 2)")
    free = f"r.min_x < r.max_x AND r.min_y < r.max_y AND NOT exists(o, es -> exists(es, e -> {enters})) AND exists(o, es -> {middle})"
    boxes = f"flatten(transform(array({_bbox(geometry)}), b -> array({', '.join(around(share) for share in shares)})))"
    return F.expr(f"get(transform(array({_outline(geometry)}), o -> get(filter({boxes}, r -> {free}), 0)), 0)")


# --- grid ---------------------------------------------------------------------------------------


def cells_of(box: Box, size: float) -> Column:
    """Grid cells (i, j) a box touches."""
    steps = lambda axis: f"sequence(floor({box['min_' + axis]} / {size}D), floor({box['max_' + axis]} / {size}D))"
    return F.expr(f"flatten(transform({steps('x')}, i -> transform({steps('y')}, j -> named_struct('i', i, 'j', j))))")


def level_of_extent(box: Box, share: int = 1) -> str:
    """Exponent of two of the smallest cell side that is at least the box's longer side over ``share``; tiny boxes share one level."""
    extent = f"greatest({box['max_x']} - {box['min_x']}, {box['max_y']} - {box['min_y']}, {2.0**-20!r}D)"
    return f"int(ceil(log2({extent} / {share})))"


def cells_at(box: Box, level: str) -> Column:
    """Cells (i, j) with a side of 2^level degrees that a box touches."""
    side = f"pow(2D, {level})"
    steps = lambda axis: f"sequence(floor({box['min_' + axis]} / {side}), floor({box['max_' + axis]} / {side}))"
    return F.expr(f"flatten(transform({steps('x')}, i -> transform({steps('y')}, j -> named_struct('i', i, 'j', j))))")


def with_cell(points: DataFrame, size: float) -> DataFrame:
    """Grid cell (i, j) of each point."""
    return points.select("*", F.expr(f"floor(lon / {size}D) AS i"), F.expr(f"floor(lat / {size}D) AS j"))


def square(x: str, y: str, side: float) -> str:
    """SQL of a closed square with its lower-left corner at (x, y), as one polygon."""
    corner = lambda px, py: f"named_struct('x', {px}, 'y', {py})"
    east, north = f"{x} + {side}D", f"{y} + {side}D"
    ring = [corner(x, y), corner(east, y), corner(east, north), corner(x, north), corner(x, y)]
    return f"array(array({', '.join(ring)}))"


def empty_geometry() -> Column:
    return F.lit(None).cast(GEOMETRY)
