"""Rebuilding of rings that cross themselves, against hand-made areas and the even-odd rule."""

from __future__ import annotations

import time

import numpy as np
import pytest

from geoledger.operators.validity import _area, _inside, rebuild_crossing, rebuild_polygon
from geoledger.schemas import GEOMETRY


def ring(*points):
    return np.array([*points, points[0]], float)


def area(polygons):
    return sum(_area(r) for polygon in polygons for r in polygon)


def covered(rings, point):
    return _inside(point, np.concatenate([r[:-1] for r in rings]), np.concatenate([r[1:] for r in rings]))


SQUARE = ring((0, 0), (4, 0), (4, 4), (0, 4))
BOW = ring((0, 0), (2, 2), (2, 0), (0, 2))


def test_valid_polygons_stay():
    hole = ring((1, 1), (1, 2), (2, 2), (2, 1))
    touching = ring((0, 2), (1, 3), (1, 1))  # one corner on the outer ring
    for rings in ([SQUARE], [SQUARE, hole], [SQUARE, touching], [SQUARE[::-1]]):
        assert rebuild_polygon(rings) is None


def test_bow_tie_becomes_two_triangles():
    assert [[r.tolist() for r in polygon] for polygon in rebuild_polygon([BOW])] == [
        [[[0, 0], [1, 1], [0, 2], [0, 0]]], [[[1, 1], [2, 0], [2, 2], [1, 1]]],
    ]


def test_figure_eight_spike_and_double_edge():
    eight = rebuild_polygon([ring((0, 0), (1, 1), (2, 0), (2, 2), (1, 1), (0, 2))])  # touches itself at a corner
    assert len(eight) == 2 and area(eight) == 2
    spiked = rebuild_polygon([ring((0, 0), (4, 0), (4, 2), (7, 2), (4, 2), (4, 4), (0, 4))])
    assert len(spiked) == 1 and area(spiked) == 16 and spiked[0][0][:, 0].max() == 4
    assert rebuild_polygon([ring((0, 0), (1, 0), (2, 0))]) == []
    there_and_back = rebuild_polygon([ring((0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (3, 4), (0, 4))])  # a cut into the inside
    assert area(there_and_back) == 16 and len(there_and_back[0]) == 1


def test_holes_are_cut_out_and_handed_to_their_ring():
    crossing = rebuild_polygon([SQUARE, ring((3, 1), (3, 3), (6, 3), (6, 1))])  # a hole that leaves the ring
    assert area(crossing) == 16 - 2 + 4
    loop = ring((0, 0), (8, 0), (8, 8), (0, 8), (0, 4), (4, 6), (4, 2), (0, 4))  # an own loop touching at a corner is a hole
    found = rebuild_polygon([loop])
    assert len(found) == 1 and [len(r) for r in found[0]] == [6, 4] and area(found) == 64 - 8
    two = rebuild_polygon([ring((0, 0), (9, 9), (9, 0), (0, 9)), ring((1, 4), (1, 5), (2, 5), (2, 4)), ring((7, 4), (7, 5), (8, 5), (8, 4))])
    assert [len(polygon) for polygon in two] == [2, 2] and area(two) == 40.5 - 2


@pytest.mark.parametrize("seed", range(12))
def test_rebuilt_polygons_cover_what_the_even_odd_rule_covers(seed):
    rng = np.random.default_rng(seed)
    coordinates = rng.integers(0, 8, (14, 2)) if seed % 2 else rng.random((40, 2))
    rings = [ring(*coordinates[:9]), ring(*coordinates[9:])]
    rings = [r[np.append(True, (np.diff(r, axis=0) != 0).any(axis=1))] for r in rings]
    found = rebuild_polygon(rings)
    parts = [r for polygon in found for r in polygon]
    assert all(_area(polygon[0]) > 0 and all(_area(hole) < 0 for hole in polygon[1:]) for polygon in found)
    for point in rng.random((400, 2)) * coordinates.max() + 1e-4:
        assert covered(rings, point) == covered(parts, point) == (sum(covered(polygon, point) for polygon in found) == 1)
    for polygon in found:
        assert rebuild_polygon(polygon) is None


def test_a_long_ring_is_not_quadratic():
    angle = np.linspace(0, 2 * np.pi, 100_001)[:-1]
    wave = 10 + np.sin(angle * 5000)
    points = np.stack([wave * np.cos(angle), wave * np.sin(angle)], axis=1)
    began = time.time()
    assert rebuild_polygon([ring(*points)]) is None
    points[[50_000, 50_003]] = points[[50_003, 50_000]]
    found = rebuild_polygon([ring(*points)])
    assert len(found[0][0]) > 99_000 and time.time() - began < 60


def test_rows_and_flags(spark):
    def shape(*rings):
        return [[[(float(x), float(y)) for x, y in r] for r in rings]]

    rows = [("bow", shape(BOW)), ("square", shape(SQUARE)), ("none", None), ("empty", []), ("flat", shape(ring((0, 0), (1, 0), (2, 0)))),
            ("both", shape(SQUARE + 9) + shape(BOW))]
    frame = spark.createDataFrame([(k, g, "clash") for k, g in rows], f"id string, geometry {GEOMETRY}, repaired string").repartition(2)
    got = {r.id: r for r in rebuild_crossing(frame).collect()}
    assert {k: r.repaired for k, r in got.items()} == {"bow": True, "square": False, "none": False, "empty": False, "flat": True, "both": True}
    assert got["none"].geometry is None and got["empty"].geometry == [] and got["flat"].geometry == []
    assert len(got["both"].geometry) == 3 and [tuple(p) for p in got["square"].geometry[0][0]] == [tuple(p) for p in SQUARE.tolist()]
    assert rebuild_crossing(frame.limit(0)).collect() == []
