"""Rings that cross themselves, rebuilt: edges are cut where they meet, and what lies inside by the even-odd rule becomes polygons.

Boundaries go through Arrow batches, one geometry at a time.  Edge pairs are looked for in the cells of a quadtree, so a long
ring costs about n log n; a polygon whose rings do not cross leaves as it came.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, StructField, StructType

LEAF = 48  # edges of a cell that are compared pair by pair
DEPTH = 40
TINY = 1e-12  # shares of an edge, and of the extent, below which points are one
ROUNDS = 8  # cutting moves edges by rounding: pieces are looked at again

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package


def _near_pairs(boxes: np.ndarray) -> np.ndarray:
    """Pairs (i < j) of boxes (min_x, min_y, max_x, max_y) that meet, each once."""
    found: list[np.ndarray] = [np.empty((0, 2), np.int64)]

    def compare(some: np.ndarray) -> None:
        x0, y0, x1, y1 = boxes[some].T
        for at in range(0, len(some), 512):
            part = slice(at, at + 512)
            meet = (x0[part, None] <= x1) & (x1[part, None] >= x0) & (y0[part, None] <= y1) & (y1[part, None] >= y0)
            meet &= some[part, None] < some
            i, j = np.nonzero(meet)
            found.append(np.stack([some[at + i], some[j]], axis=1))

    stack = [(np.arange(len(boxes)), np.append(boxes[:, :2].min(axis=0), boxes[:, 2:].max(axis=0)), 0)]
    while stack:
        some, (x0, y0, x1, y1), depth = stack.pop()
        middle_x, middle_y = (x0 + x1) / 2, (y0 + y1) / 2
        parts = []
        if len(some) > LEAF and depth < DEPTH:
            west, east = boxes[some, 0] <= middle_x, boxes[some, 2] >= middle_x
            south, north = boxes[some, 1] <= middle_y, boxes[some, 3] >= middle_y
            corners = ((west & south, (x0, y0, middle_x, middle_y)), (east & south, (middle_x, y0, x1, middle_y)),
                       (west & north, (x0, middle_y, middle_x, y1)), (east & north, (middle_x, middle_y, x1, y1)))
            parts = [(some[inside], box, depth + 1) for inside, box in corners if inside.any()]
        if parts and max(len(part[0]) for part in parts) < 0.9 * len(some):
            stack.extend(parts)
        else:
            compare(some)
    i, j = np.concatenate(found).T
    return np.stack(np.divmod(np.unique(i * len(boxes) + j), len(boxes)), axis=1)


def _cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]


def _meetings(start: np.ndarray, end: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(edge, point, pair, inner) where edges of a pair meet, once for either edge; inner: at no common end of both."""
    p, r, q, s = start[pairs[:, 0]], (end - start)[pairs[:, 0]], start[pairs[:, 1]], (end - start)[pairs[:, 1]]
    turn = _cross(r, s)
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = _cross(q - p, s) / turn, _cross(q - p, r) / turn
    for share in (t, u):  # at an end up to rounding is at the end
        share[np.abs(share) < TINY], share[np.abs(share - 1) < TINY] = 0, 1
    hit = (turn != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    point = p + t[:, None] * r
    for share, other in ((t, 0), (u, 1)):  # where an end lies on the other edge, that end is the point
        for at, ends in ((0, start), (1, end)):
            point[share == at] = ends[pairs[share == at, other]]
    edges, points, of = [pairs[hit].T.ravel()], [np.tile(point[hit], (2, 1))], [np.tile(np.flatnonzero(hit), 2)]
    inner = [np.tile(~(np.isin(t, (0, 1)) & np.isin(u, (0, 1)))[hit], 2)]
    along = np.flatnonzero((turn == 0) & (_cross(q - p, r) == 0))
    for one, other in ((0, 1), (1, 0)):  # edges on one line: ends of the one inside the other
        a, b = pairs[along, one], pairs[along, other]
        for ends in (start, end):
            low, high = np.minimum(start[a], end[a]), np.maximum(start[a], end[a])
            on = ((ends[b] >= low) & (ends[b] <= high)).all(axis=1)
            same = (ends[b] == start[a]).all(axis=1) | (ends[b] == end[a]).all(axis=1)
            edges.append(a[on]), points.append(ends[b][on]), of.append(along[on]), inner.append(~same[on])
    return np.concatenate(edges), np.concatenate(points), np.concatenate(of), np.concatenate(inner)


def _merged(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct points, those closer than rounding as the first of them, and which of them each point is."""
    step = max(np.abs(points).max(), np.finfo(float).tiny) * TINY
    x, y = np.rint(points / step).T
    order = np.lexsort((y, x))  # stable: the first of equal ones comes first
    new = np.append(True, (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0))
    which = np.empty(len(points), np.int64)
    which[order] = np.cumsum(new) - 1
    return points[order[new]], which


def _area(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum()) / 2


def _inside(point: np.ndarray, start: np.ndarray, end: np.ndarray) -> bool:
    """Even-odd test by the edges that the ray to the right meets."""
    over = (start[:, 1] > point[1]) != (end[:, 1] > point[1])
    a, b = start[over], end[over]
    x = a[:, 0] + (point[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])
    return bool((x > point[0]).sum() % 2)


def _faces(points: np.ndarray, segments: np.ndarray) -> list[list[int]]:
    """Closed walks (node numbers) around what lies inside, on their left; every node has an even number of segments."""
    n = len(segments)
    tail, head = np.concatenate([segments[:, 0], segments[:, 1]]), np.concatenate([segments[:, 1], segments[:, 0]])
    twin = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    off = points[head] - points[tail]
    order = np.lexsort((np.arctan2(off[:, 1], off[:, 0]), tail))  # around every node, counter-clockwise
    place = np.empty(2 * n, np.int64)
    place[order] = np.arange(2 * n)
    first = np.searchsorted(tail[order], tail)
    last = np.searchsorted(tail[order], tail, side="right") - 1
    before = order[np.where(place == first, last, place - 1)]  # the neighbour in clockwise direction
    following = before[twin]

    face, walks = np.full(2 * n, -1), []
    for begin in range(2 * n):
        walk, at = [], begin
        while face[at] < 0:
            face[at] = len(walks)
            walk.append(at)
            at = following[at]
        if walk:
            walks.append(walk)
    outer = [_area(points[tail[walk + walk[:1]]]) for walk in walks]

    inside = np.full(len(walks), -1)
    for begin in np.argsort(outer, kind="stable"):  # the outside of a component comes before its other faces
        if inside[begin] >= 0:
            continue
        component, stack = {int(begin)}, [int(begin)]
        while stack:
            for other in set(face[twin[walks[stack.pop()]]].tolist()) - component:
                component.add(other)
                stack.append(other)
        others = ~np.isin(face[:n], list(component))
        around = _inside(points[tail[walks[begin][0]]], points[tail[:n][others]], points[head[:n][others]])
        inside[begin], stack = int(around), [int(begin)]
        while stack:  # crossing a segment changes sides
            now = stack.pop()
            for other in set(face[twin[walks[now]]].tolist()):
                if inside[other] < 0:
                    inside[other] = 1 - inside[now]
                    stack.append(other)
    return [tail[walk].tolist() for walk, kept in zip(walks, inside) if kept == 1]


def _simple_loops(walk: list[int]) -> Iterator[list[int]]:
    """A closed walk cut at the nodes it passes twice."""
    path: list[int] = []
    seen: dict[int, int] = {}
    for node in [*walk, walk[0]]:
        if node in seen:
            loop = path[seen[node] :]
            yield loop
            for gone in loop[1:]:
                del seen[gone]
            del path[seen[node] + 1 :]
        else:
            seen[node] = len(path)
            path.append(node)


def rebuild_polygon(rings: list[np.ndarray]) -> list[list[np.ndarray]] | None:
    """Polygons of what the rings enclose by the even-odd rule; None where no ring crosses or touches itself or crosses another.

    Edges are cut where they meet, pieces that lie on each other cancel in pairs.  Outer rings run counter-clockwise, holes clockwise, each
    from its smallest point; polygons are ordered by it.
    """
    start, end = np.concatenate([ring[:-1] for ring in rings]), np.concatenate([ring[1:] for ring in rings])
    of_ring = np.repeat(np.arange(len(rings)), [len(ring) - 1 for ring in rings])
    if not len(start):
        return None
    pairs = _near_pairs(np.concatenate([np.minimum(start, end), np.maximum(start, end)], axis=1))
    edge, point, pair, inner = _meetings(start, end, pairs)
    a, b = pairs.T
    first, size = (np.searchsorted(of_ring, of_ring, side) for side in ("left", "right"))
    follows = (b == a + 1) | ((a == first[a]) & (b == size[a] - 1))
    own = of_ring[a] == of_ring[b]
    crossed = (own[pair] & inner) | (own & ~follows)[pair]  # an own edge met anywhere but at the next corner
    if not len(pair) or (not crossed.any() and own[pair].all()):
        return None
    found = _rebuilt(start, end, edge, point)
    if not crossed.any():  # rings that only touch enclose what they say
        plain = [abs(_area(ring)) for ring in rings]
        if np.isclose(plain[0] - sum(plain[1:]), sum(_area(ring) for polygon in found for ring in polygon), rtol=1e-9, atol=0):
            return None
    return found


def _rebuilt(start: np.ndarray, end: np.ndarray, edge: np.ndarray, point: np.ndarray) -> list[list[np.ndarray]]:
    """Polygons of what the edges enclose when each is cut at its points."""
    nodes, number = _merged(np.concatenate([start, end, point]))
    pieces = np.stack([number[: len(start)], number[len(start) : 2 * len(start)]], axis=1)
    cuts = number[2 * len(start) :]
    for _ in range(ROUNDS):
        edges = np.concatenate([np.arange(len(pieces)), np.arange(len(pieces)), edge])
        stops = np.concatenate([pieces[:, 0], pieces[:, 1], cuts])
        far = ((nodes[stops] - nodes[pieces[edges, 0]]) ** 2).sum(axis=1)
        order = np.lexsort((far, edges))
        stops, edges = stops[order], edges[order]
        joined = (edges[1:] == edges[:-1]) & (stops[1:] != stops[:-1])
        pieces = np.sort(np.stack([stops[:-1], stops[1:]], axis=1)[joined], axis=1)
        codes, times = np.unique(pieces[:, 0] * len(nodes) + pieces[:, 1], return_counts=True)
        pieces = np.stack(np.divmod(codes[times % 2 == 1], len(nodes)), axis=1)
        if not len(pieces):
            return []
        ends = nodes[pieces]
        pairs = _near_pairs(np.concatenate([ends.min(axis=1), ends.max(axis=1)], axis=1))
        edge, point, _, inner = _meetings(ends[:, 0], ends[:, 1], pairs)
        if not inner.any():
            break
        nodes, number = _merged(np.concatenate([nodes, point]))
        pieces, cuts = number[pieces], number[-len(point) :]
    order = np.lexsort((nodes[:, 1], nodes[:, 0]))  # nodes in order of x and y
    place = np.empty(len(nodes), np.int64)
    place[order] = np.arange(len(nodes))
    nodes, pieces = nodes[order], np.sort(place[pieces], axis=1)

    outers, holes = [], []
    for walk in _faces(nodes, pieces):
        for loop in _simple_loops(walk):
            at = loop.index(min(loop))  # nodes are numbered in order of x and y
            ring = nodes[loop[at:] + loop[: at + 1]]
            area = _area(ring)
            if area:
                (outers if area > 0 else holes).append((abs(area), ring))
    outers.sort(key=lambda item: item[1][0].tolist())
    polygons = [[ring] for _, ring in outers]
    by_area = np.argsort([area for area, _ in outers], kind="stable")
    for _, hole in sorted(holes, key=lambda item: item[1][0].tolist()):
        middle = (hole[0] + hole[1]) / 2
        owner = next((n for n in by_area if _inside(middle, outers[n][1][:-1], outers[n][1][1:])), None)
        if owner is not None:
            polygons[owner].append(hole)
    return polygons


def rebuild_crossing(areas: DataFrame, geometry: str = "geometry", flag: str = "repaired") -> DataFrame:
    """``areas`` with the polygons whose rings cross or touch themselves, or cross each other, rebuilt, and ``flag`` true there.

    Rings must be closed (``repair_rings``).  A polygon of which nothing is left goes.  Null geometries stay null, unflagged;
    a column named like the flag is replaced.  Overlaps between the polygons of one area are left as they are.
    """
    kept = areas.drop(flag)
    at = kept.columns.index(geometry)

    def nested(column: pa.Array) -> Iterator[list[list[np.ndarray]] | None]:
        rings, points = column.values, column.values.values
        flat = points.values
        xy = np.stack([flat.field(name).to_numpy(zero_copy_only=False) for name in ("x", "y")], axis=1)
        whole, polygon, ring = (part.offsets.to_numpy() for part in (column, rings, points))
        for n, valid in enumerate(column.is_valid().to_pylist()):
            yield [[xy[ring[k] : ring[k + 1]] for k in range(polygon[p], polygon[p + 1])] for p in range(whole[n], whole[n + 1])] if valid else None

    def lists(sizes: list[int], values: pa.Array, valid: np.ndarray | None = None) -> pa.Array:
        ends = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
        return pa.ListArray.from_arrays(ends, values, mask=None if valid is None else pa.array(~valid))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, flags = [], []
            for polygons in nested(batch.column(at)):
                rebuilt = [rebuild_polygon(polygon) if polygon else None for polygon in polygons or []]
                flags.append(any(found is not None for found in rebuilt))
                fresh = ([polygon] if found is None else found for polygon, found in zip(polygons or [], rebuilt))
                out.append(None if polygons is None else [polygon for some in fresh for polygon in some])
            polygons = [polygon for area in out if area for polygon in area]
            rings = [ring for polygon in polygons for ring in polygon]
            xy = np.concatenate([np.empty((0, 2)), *rings])
            points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
            column = lists([len(polygon) for polygon in polygons], lists([len(ring) for ring in rings], points))
            column = lists([len(area or []) for area in out], column, np.array([area is not None for area in out], bool))
            columns = [*batch.columns, pa.array(flags, pa.bool_())]
            columns[at] = column
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, flag])

    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField(flag, BooleanType())]))
