from __future__ import annotations

import json
import math
import re

import pytest
from pyspark.sql import functions as F

from geoledger.functions import geometry as G
from geoledger.operators import areas as M
from geoledger.operators import transactions as P
from geoledger.operators.imports import import_areas
from geoledger.sources import files as S


def _square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]


def _shape(rows, polygons):
    return rows([(polygons,)], "geometry array<array<array<struct<x:double,y:double>>>>")


def _value(rows, polygons, expr):
    return _shape(rows, polygons).select(expr("geometry")).first()[0]


BOX = G.viewport_box(G.Viewport(10, 0, 0, 1, 1))


def test_ring_area_and_hole(rows):
    assert _value(rows, [[_square(0.0, 0.0, 2.0)]], lambda g: G.ring_area(f"{g}[0][0]")) == 4.0
    whole = _value(rows, [[_square(1.0, 45.0, 1.0)]], G.mercator_area)
    hole = _value(rows, [[_square(1.0, 45.0, 1.0), _square(1.2, 45.2, 0.5)]], G.mercator_area)
    part = _value(rows, [[_square(1.2, 45.2, 0.5)]], G.mercator_area)
    assert math.isclose(whole - part, hole, rel_tol=1e-12)
    y = lambda lat: 6378137 * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))
    assert math.isclose(whole, 6378137 * math.radians(1) * (y(46) - y(45)), rel_tol=1e-9)


@pytest.mark.parametrize(
    ("polygons", "expected"),
    [
        ([[_square(0.2, 0.2, 0.1)]], True),  # inside the box
        ([[_square(-5.0, -5.0, 20.0)]], True),  # around the box
        ([[_square(1.0, 0.0, 1.0)]], True),  # shares a border
        ([[_square(1.0, 1.0, 1.0)]], True),  # shares a corner
        ([[_square(1.1, 0.0, 1.0)]], False),
        ([[[(-1.0, 0.5), (2.0, 0.5), (2.0, 0.6), (-1.0, 0.6), (-1.0, 0.5)]]], True),  # band across
        ([[[(1.0, -1.0), (3.0, 1.0), (3.0, -1.0), (1.0, -1.0)]]], False),  # box overlap only
        ([[_square(-5.0, -5.0, 20.0), _square(-1.0, -1.0, 3.0)]], False),  # the box lies in a hole
        ([[_square(5.0, 5.0, 1.0)], [_square(0.5, 0.5, 3.0)]], True),  # second polygon
    ],
)
def test_intersects_box(rows, polygons, expected):
    assert _value(rows, polygons, lambda g: G.intersects_box(g, BOX)) is expected


def test_border_point_is_outside(rows):
    points = rows([(0.5, 0.5), (0.0, 0.5), (1.0, 1.0), (0.5, 1.0), (None, 0.5)], "lon double, lat double")
    inside = points.select(G.within_box("lon", "lat", BOX)).collect()
    assert [r[0] for r in inside] == [True, False, False, False, None]
    shape = [[_square(0.0, 0.0, 1.0), _square(0.4, 0.4, 0.2)]]
    for x, y, expected in ((0.1, 0.1, True), (0.0, 0.5, False), (1.0, 0.5, False), (0.5, 0.5, False), (0.4, 0.5, False), (2, 2, False)):
        found = _value(rows, shape, lambda g: G.contains_point(g, f"{float(x)}D", f"{float(y)}D"))
        assert found is expected, (x, y)


def test_wkt_round_trip(rows):
    polygons = [[_square(-1.5, 48.0, 2.0), _square(-1.0, 48.5, 0.25)], [_square(10.0, 1e-7, 1.0)]]
    df = _shape(rows, polygons).withColumn("text", G.to_wkt("geometry")).withColumn("again", G.from_wkt("text"))
    row = df.first()
    assert row["again"] == row["geometry"]
    text = _value(rows, [[_square(2.0, 48.0, 1.0)]], G.to_wkt)
    assert text == "MULTIPOLYGON (((2 48, 3 48, 3 49, 2 49, 2 48)))"


def test_repair(rows):
    broken = [[[(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)], [(0.2, 0.2), (0.3, 0.3)]], [[(5.0, 5.0), (6.0, 6.0)]]]
    fixed = _value(rows, broken, G.repair_rings)
    assert [[[tuple(p) for p in ring] for ring in polygon] for polygon in fixed] == [[_square(0.0, 0.0, 1.0)]]
    bow = [[[(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]]]
    assert _value(rows, bow, G.is_simple) is False
    assert _value(rows, [[_square(0.0, 0.0, 1.0)]], G.is_simple) is True


def test_mixed_geometry_file(spark, tmp_path):
    ring = [list(p) for p in _square(2.0, 48.0, 1.0)]
    quoted = [[[json.dumps(p).replace(" ", "") for p in ring]]]
    features = [
        {"type": "Feature", "properties": {"code": code, "nom": "x", "departement": "01", "region": "84"}, "geometry": g}
        for code, g in (
            ("01053", {"type": "Polygon", "coordinates": [ring]}),
            ("01054", {"type": "MultiPolygon", "coordinates": [[ring]]}),
            ("01055", {"type": "MultiPolygon", "coordinates": quoted}),
            ("01056", None),
        )
    ]
    path = tmp_path / "cities.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    areas = S.read_areas_geojson(spark, str(path), "city")
    found = {r["city_id"]: r for r in areas.collect()}
    assert found["01053"]["geometry"] == found["01054"]["geometry"] == found["01055"]["geometry"]
    assert found["01056"]["geometry"] is None
    assert (found["01053"]["min_x"], found["01053"]["max_y"]) == (2.0, 49.0)
    S.write_areas(areas, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    with pytest.raises(ValueError):
        S.read_areas_geojson(spark, str(path), "country")


def test_csv_codes_keep_zeros(spark, tmp_path):
    header = "id_mutation,date_mutation,valeur_fonciere,code_postal,code_commune,nom_commune,id_parcelle,surface_reelle_bati,surface_terrain,longitude,latitude,extra\n"
    body = '1,2023-01-05,1000.5,01000,01053,"Bourg ""en""\nBresse",p1,10,,5.2,46.2,x\n2,bad,abc,01000,01053,Bourg,p2,,,,,\n'
    (tmp_path / "a.csv").write_text(header + body)
    (tmp_path / "note.txt").write_text("not a table")
    tx = P.conform_transactions(S.read_transactions_csv(spark, str(tmp_path)))
    first, second = tx.orderBy("tx_id").collect()
    assert (first["postal_code"], first["city_id"], first["city_name"], first["price"]) == ("01000", "01053", 'Bourg "en"\nBresse', 1000.5)
    assert (first["lon"], first["lat"]) == (5.2, 46.2)
    assert (second["tx_date"], second["price"]) == (None, None)
    assert P.drop_incomplete(tx).count() == 1


# --- map ----------------------------------------------------------------------------------------


def _level(rows, level, n, prices=None):
    geometry = [[_square(0.2, 0.2, 0.1)]]
    names = {"city": ("department_id", "region_id"), "department": ("region_id",), "region": ()}[level]
    areas = rows(
        [(str(i), f"{level}{i}", *["0"] * len(names), geometry, 0.2, 0.2, 0.3, 0.3) for i in range(n)],
        f"{level}_id string, name string, " + "".join(f"{c} string, " for c in names)
        + "geometry array<array<array<struct<x:double,y:double>>>>, min_x double, min_y double, max_x double, max_y double",
    )
    stats = rows(
        [(str(i), 5, 100.0, 5000.0, p) for i, p in enumerate(prices or [])],
        f"{level}_id string, transactions bigint, price_min double, price_max double, price_m2_mean double",
    )
    return areas, stats


def _no_cities(rows):
    return rows([], "city_id string, review_count bigint, scores struct<mean:double>")


@pytest.mark.parametrize(
    ("n_city", "n_department", "expected"),
    [(499, 3, "city"), (500, 3, "department"), (500, 500, "region")],
)
def test_level_fallback(rows, n_city, n_department, expected):
    levels = {"city": _level(rows, "city", n_city), "department": _level(rows, "department", n_department), "region": _level(rows, "region", 2)}
    view = G.Viewport(12, 0, 0, 1, 1)
    found = M.areas_in_viewport(levels, _no_cities(rows), view).select("level").distinct().collect()
    assert [r["level"] for r in found] == [expected]


def test_unknown_level(rows):
    with pytest.raises(ValueError):
        M.areas_in_viewport({}, _no_cities(rows), G.Viewport(1, 0, 0, 1, 1), level="country")


def test_map_feature_and_document(rows):
    areas, stats = _level(rows, "city", 2, [2000.0, 3000.0])
    features = M.map_features(areas, stats, "city", _no_cities(rows))
    bounds = M.legend_bounds(features).first()
    assert (bounds["min_price"], bounds["max_price"]) == (2000.0, 3000.0)
    document = json.loads(M.feature_collection(features, "city").first()["document"])
    assert [f["properties"]["id"] for f in document["features"]] == ["0", "1"]
    assert document["features"][0]["properties"] == {
        "id": "0", "agglomeration_id": "0", "name": "city0", "price": 2000.0, "max_price": 5000.0, "min_price": 100.0,
        "satisfaction": None, "word_cloud_url": "api/v1/word-clouds/cities/0", "sentiments_url": "api/v1/sentiments/cities/0",
    }
    assert document["features"][0]["geometry"]["type"] == "MultiPolygon"
    assert document["metadata"] == {"name": "Villes", "min_price": 2000.0, "max_price": 3000.0, "show": True}


def test_empty_view_still_has_a_name(rows):
    levels = {level: _level(rows, level, 2) for level in ("city", "department", "region")}
    document = json.loads(M.viewport_document(levels, _no_cities(rows), G.Viewport(12, 50, 50, 51, 51)).first()["document"])
    assert document["features"] == []
    assert document["metadata"] == {"name": "Villes", "min_price": 0.0, "max_price": 0.0, "show": True}


def test_masked_price_and_empty_legend(rows):
    areas, stats = _level(rows, "city", 1, [499.99])
    features = M.map_features(areas, stats, "city", _no_cities(rows))
    assert features.first()["price"] is None
    assert tuple(M.legend_bounds(features).first()) == (0.0, 0.0)


def test_agglomerations(rows):
    ids = rows([("75056",), ("13055",), ("01053",), ("75101",), ("2A004",)], "city_id string")
    expanded = [r["city_id"] for r in P.expand_agglomeration(ids).collect()]
    assert len(expanded) == 20 + 16 + 3 and "75120" in expanded and "13216" in expanded and "75056" not in expanded
    parents = {r["city_id"]: r["agglomeration_id"] for r in P.with_agglomeration_id(ids).collect()}
    assert parents["75101"] == "75056" and parents["2A004"] == "2A004"


def test_listing_needs_every_level(rows):
    levels = {"city": _level(rows, "city", 2, [900.0]), "department": _level(rows, "department", 0), "region": _level(rows, "region", 1)}
    with pytest.raises(Exception, match="no areas"):
        M.area_listing(levels).collect()


def test_colours(rows):
    df = rows([("a", 1000.0), ("b", 3000.0), ("c", 2000.0), ("d", None), ("e", 9000.0)], "id string, price double")
    found = {r["id"]: (r["hue"], r["lightness"], r["colour"]) for r in M.choropleth(df, "price", F.lit(1000.0), F.lit(3000.0)).collect()}
    assert found["a"] == (180.0, 20.0, "hsl(180.0, 100%, 20.0%)") and found["b"][:2] == found["e"][:2] == (0.0, 60.0)
    assert found["c"][:2] == (90.0, 40.0) and found["d"] == (None, None, "#888888")
    scores = rows([("a", 5.0), ("b", 2.5)], "id string, satisfaction double")
    assert [r["hue"] for r in M.satisfaction_colours(scores).orderBy("id").collect()] == [180.0, 0.0]
    assert tuple(M.legend_ticks(rows([(0.0, 5.0)], "min_price double, max_price double")).first()) == (0, 3, 5)


def test_points_in_areas_matches_brute_force(rows):
    areas = rows(
        [(str(i), [[_square(i * 0.7, i * 0.3, 1.0)]], i * 0.7, i * 0.3, i * 0.7 + 1.0, i * 0.3 + 1.0) for i in range(6)],
        "area_id string, geometry array<array<array<struct<x:double,y:double>>>>, min_x double, min_y double, max_x double, max_y double",
    )
    points = [((i * 37 % 500) / 100, (i * 91 % 300) / 100, float(i), None if i % 4 else 2.0, 1.0) for i in range(800)] + [(1.0, 0.5, 7.0, None, None)] * 300
    tx = rows(points, "lon double, lat double, price double, built_area double, land_area double")
    found = {r["area_id"]: (r["transactions"], r["price_mean"]) for r in P.points_in_areas(tx, areas, cell=0.4).collect()}
    for i in range(6):
        x, y = i * 0.7, i * 0.3
        hit = [p for p in points if x < p[0] < x + 1.0 and y < p[1] < y + 1.0]
        if hit:
            assert found[str(i)][0] == len(hit)
            assert math.isclose(found[str(i)][1], sum(p[2] for p in hit) / len(hit))
        else:
            assert str(i) not in found


def _boxes(spark, columns):
    return columns.selectExpr("*", "array(array(array(named_struct('x', min_x, 'y', min_y), named_struct('x', max_x, 'y', min_y),"
                              " named_struct('x', max_x, 'y', max_y), named_struct('x', min_x, 'y', max_y), named_struct('x', min_x, 'y', min_y)))) AS geometry")  # fmt: skip


def test_crowded_places_give_few_candidates(spark):
    """35 000 touching areas, some large ones over them, and a third of all points in one spot of one cell."""
    small = spark.range(35_000).selectExpr("string(id) AS area_id", "(id % 187) * 0.05D AS min_x", "40 + (id div 187) * 0.05D AS min_y")
    small = small.selectExpr("*", "min_x + 0.05D AS max_x", "min_y + 0.05D AS max_y")
    large = spark.createDataFrame([("north", 0.0, 45.0, 9.35, 49.5), ("far", 170.0, -80.0, 179.0, -60.0)], small.schema)
    areas = _boxes(spark, small.unionByName(large))
    n = F.col("id")
    place = lambda salt, low, size: F.lit(low) + F.pmod(F.xxhash64(n, F.lit(salt)), F.lit(10**9)) / 1e9 * size
    hot = n % 3 == 0
    tx = spark.range(60_000).select(
        F.when(hot, place(1, 4.001, 0.003)).otherwise(place(1, 0.0, 9.0)).alias("lon"),
        F.when(hot, place(2, 44.001, 0.003)).otherwise(place(2, 40.0, 9.0)).alias("lat"),
        F.lit(100.0).alias("price"), F.lit(None).cast("double").alias("built_area"), F.lit(1.0).alias("land_area"),
    )
    candidates = P.spots_near_areas(tx.select("lon", "lat"), areas).count()
    found = {r["area_id"]: r["transactions"] for r in P.points_in_areas(tx, areas).collect()}
    assert candidates < 3 * sum(found.values())
    rows = tx.select("lon", "lat").collect()
    assert found["north"] == sum(0 < r.lon < 9.35 and 45 < r.lat < 49.5 for r in rows) and "far" not in found
    assert max(found.values()) > 20_000 and sum(v for k, v in found.items() if k != "north") == 60_000


def test_viewports_of_all_sizes_meet_areas_of_all_sizes(spark):
    import random

    draw = random.Random(3)

    def boxes(n):
        for i in range(n):
            size, x, y = 2.0 ** draw.uniform(-6, 4), draw.uniform(-20, 20), draw.uniform(-20, 20)
            yield (i, x, y, x + size, y + size * draw.choice([0.01, 0.5, 1]))

    a, v = [*boxes(150), (900, 1.0, 1.0, 1.0, 1.0)], [*boxes(120), (901, 1.0, 1.0, 1.0, 1.0), (902, -64.0, -64.0, 64.0, 64.0)]
    areas = _boxes(spark, spark.createDataFrame(a, "city_id long, min_x double, min_y double, max_x double, max_y double"))
    views = spark.createDataFrame(v, "view_id long, sw_lon double, sw_lat double, ne_lon double, ne_lat double")
    got = [(r.view_id, r.city_id) for r in M.intersecting_many(areas, views).collect()]
    want = {(w[0], b[0]) for w in v for b in a if w[1] <= b[3] and w[3] >= b[1] and w[2] <= b[4] and w[4] >= b[2]}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 200


def test_import_areas_reports_unreadable_outlines(spark, tmp_path):
    def collection(*features):
        body = ",".join(
            f'{{"type":"Feature","properties":{{"code":"{c}","nom":"{n}"}},"geometry":{{"type":"Polygon","coordinates":{g}}}}}'
            for c, n, g in features
        )
        return f'{{"type":"FeatureCollection","features":[{body}]}}'

    square = "[[[0,0],[1,0],[1,1],[0,1],[0,0]]]"
    for run, lines in enumerate([collection(("1", "one", square)), collection(("1", "new", '"broken"'), ("2", "two", square))]):
        (tmp_path / f"in{run}").mkdir()
        (tmp_path / f"in{run}" / "a.json").write_text(lines)
    import_areas(spark, {"region": str(tmp_path / "in0")}, str(tmp_path / "t0"))
    stored = import_areas(spark, {"region": str(tmp_path / "in1")}, str(tmp_path / "t1"), str(tmp_path / "t0"))
    assert {(r["region_id"], r["name"], r["max_x"]) for r in stored["region"].collect()} == {("1", "one", 1.0), ("2", "two", 1.0)}
    lost = spark.read.parquet(str(tmp_path / "t1" / "unreadable" / "region")).collect()
    assert [(r["region_id"], r["name"]) for r in lost] == [("1", "new")]


@pytest.mark.parametrize(
    ("polygons", "expected"),
    [
        ([[_square(1.0, 1.0, 2.0)]], (1.0, 1.0, 3.0, 3.0)),
        ([[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (3.5, 3.9), (0.0, 4.0), (0.0, 0.0)]]], (0.5, 0.5, 3.5, 3.5)),  # a dent in a corner
        ([[_square(0.0, 0.0, 4.0), _square(1.9, 1.9, 0.2)]], None),  # a hole in the middle
        ([[_square(0.0, 0.0, 1.0)], [_square(3.0, 3.0, 1.0)]], None),
        ([], None),
        (None, None),
    ],
)
def test_inner_box(rows, polygons, expected):
    found = _value(rows, polygons, G.inner_box)
    assert (found and tuple(found)) == expected


def test_viewports_meet_outlines_not_boxes(spark):
    """Diamonds with holes against a brute-force exact test; pairs are found by many tasks, from one file of viewports too."""
    import random

    draw = random.Random(5)

    def diamond(x, y, r):
        ring = lambda r: [(x - r, y), (x, y - r), (x + r, y), (x, y + r), (x - r, y)]
        return [[ring(r), ring(r / 4)]] if draw.random() < 0.5 else [[ring(r)]]

    spots = [(i, draw.uniform(0, 9), draw.uniform(0, 9), draw.uniform(0.1, 1.2)) for i in range(60)]
    made = [(i, f"a{i}", diamond(x, y, r), x - r, y - r, x + r, y + r) for i, x, y, r in spots]
    made += [made[0], (None, "x", *made[1][2:]), (77, "none", None, 0.0, 0.0, 9.0, 9.0)]  # a repeated key, none, no geometry
    kind = "city_id long, level string, geometry array<array<array<struct<x:double,y:double>>>>, min_x double, min_y double, max_x double, max_y double"
    areas = spark.createDataFrame(made, kind)
    view = [(i, draw.uniform(0, 9), draw.uniform(0, 9), 2.0 ** draw.uniform(-5, 1)) for i in range(80)]
    views = spark.createDataFrame([(i, x, y, x + s, y + s) for i, x, y, s in view], "view_id long, sw_lon double, sw_lat double, ne_lon double, ne_lat double")
    found = M.intersecting_many(areas, views.coalesce(1))
    assert found.columns == ["city_id", "view_id", *areas.columns[1:]]
    got = sorted((r.view_id, r.city_id) for r in found.collect())
    box = {"min_x": "sw_lon", "min_y": "sw_lat", "max_x": "ne_lon", "max_y": "ne_lat"}
    all_pairs = areas.where("city_id is not null").withColumnsRenamed({c: f"a_{c}" for c in G.CORNERS}).crossJoin(views)
    want = [(r.view_id, r.city_id) for r in all_pairs.where(G.intersects_box("geometry", box)).collect()]
    want += [p for p in want if p[1] == 0]  # both rows of a repeated key with both boxes, as ever
    assert got == sorted(want) and len(want) > 100
    assert "SortMergeJoin [level" in found._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_viewports_are_cheap_to_make(spark):
    """Rectangles under boxes of their own, larger, smaller and apart, and viewports that stand on their head, against brute force;
    the pairs come from many tasks whatever their bytes, and no cell is computed per pair."""
    import random

    draw = random.Random(9)
    made = []
    for i in range(90):
        x, y, r = draw.randrange(0, 9), draw.randrange(0, 9), draw.choice([0.5, 1.0, 3.0])
        west, south, east, north = [(0, 0, 0, 0), (-1, -1, 1, 1), (0.25, 0.25, -0.2, -0.2), (r + 1, 0, 2, 0)][i % 4 if i % 3 else 0]
        made.append((i, [[_square(float(x), float(y), r)]], x + west, y + south, x + r + east, y + r + north))
    kind = "city_id long, geometry array<array<array<struct<x:double,y:double>>>>, min_x double, min_y double, max_x double, max_y double"
    areas = spark.createDataFrame([(*row[:2], *map(float, row[2:])) for row in made], kind)
    corners = [(draw.randrange(0, 40) / 4, draw.randrange(0, 40) / 4, draw.choice([0.5, 2.0])) for _ in range(80)]
    view = [(i, x, y, x + s, y + s) if i % 9 else (i, x, y, x - 0.25, y + s) for i, (x, y, s) in enumerate(corners)]
    views = spark.createDataFrame(view, "view_id long, sw_lon double, sw_lat double, ne_lon double, ne_lat double")
    found = M.intersecting_many(areas, views)
    box = {"min_x": "sw_lon", "min_y": "sw_lat", "max_x": "ne_lon", "max_y": "ne_lat"}
    exact = areas.crossJoin(views).where(G.overlaps_box(box)).where(G.intersects_box("geometry", box)).collect()
    want = sorted((r.view_id, r.city_id) for r in exact)
    assert sorted((r.view_id, r.city_id) for r in found.collect()) == want and len({v for v, _ in want if v % 9 == 0}) > 2
    plan = found.select("view_id", "city_id")._jdf.queryExecution().sparkPlan().toString()
    joins = [line for line in plan.split("\n") if "SortMergeJoin [level" in line]
    assert joins and not any("FLOOR" in line or "pow" in line for line in joins)
    assert found.rdd.getNumPartitions() >= M.TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def test_points_are_folded_before_they_are_shuffled(spark):
    """Diamonds with a hole over many points, against an exact test of every pair; positions leave their cell's task folded per area."""
    import random

    draw = random.Random(9)
    ring = lambda x, y, r: [(x - r, y), (x, y - r), (x + r, y), (x, y + r), (x - r, y)]
    spots = [(f"a{i}", draw.uniform(0, 5), draw.uniform(0, 5), draw.uniform(0.3, 2)) for i in range(25)]
    made = [(name, [[ring(x, y, r), ring(x, y, r / 3)]], x - r, y - r, x + r, y + r) for name, x, y, r in spots]
    made += [made[0], (None, *made[1][1:]), ("none", None, 0.0, 0.0, 5.0, 5.0)]  # a repeated id, none, no geometry
    areas = spark.createDataFrame(
        made, "area_id string, geometry array<array<array<struct<x:double,y:double>>>>, min_x double, min_y double, max_x double, max_y double"
    )
    points = [(draw.randrange(500) / 100, draw.randrange(500) / 100, float(i), None, 1.0) for i in range(1500)]
    tx = spark.createDataFrame(points, "lon double, lat double, price double, built_area double, land_area double")
    found = P.points_in_areas(tx, areas)
    got = {r["area_id"]: (r["transactions"], round(r["price_mean"], 6)) for r in found.collect()}
    pairs = areas.where("area_id is not null").crossJoin(tx).where(G.contains_point("geometry", "lon", "lat"))
    want = pairs.groupBy("area_id").agg(F.count("*").alias("n"), F.avg("price").alias("price"))
    # a repeated id counts each of its boxes with each of its outlines, as ever
    assert got == {r["area_id"]: (r["n"] * (2 if r["area_id"] == "a0" else 1), round(r["price"], 6)) for r in want.collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Join \[(\w+)#", plan).group(1) == "level"  # the pairs of this join meet nothing more
