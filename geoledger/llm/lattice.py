"""Embedding near-dedup by lattice hashing: random projections decoded to E8 points, neighbouring cells probed, cosine verified."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm.common import ship_with_tasks
from geoledger.llm.components import component_labels
from geoledger.sources.scratch import materialise

MIN_COSINE = 0.95
TABLES = 10
#: E8 points joined to one cell: 16 projected dimensions.
BLOCKS = 2
#: Length of a unit vector's projection per dimension, in units of the lattice (shortest distance sqrt 2).
SCALE = 0.7
#: Cells looked up per vector and table besides its own.
PROBES = 16
SEED = 7

ship_with_tasks(__name__)


def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled so that they are integers."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            whole.append(v)
    half = [v for v in product((1, -1), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + [list(v) for v in half], dtype=np.int64)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd move the worst coordinate the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    if len(odd):
        off = x[odd] - near[odd]
        worst = np.abs(off).argmax(axis=1)
        step = np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        near[odd, worst] += step
    return near


def e8_decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row, doubled: the closer of the even-sum integer point and its shift by one half."""
    plain, shifted = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - plain) ** 2).sum(axis=1) <= ((x - shifted) ** 2).sum(axis=1)
    return np.rint(2 * np.where(closer[:, None], plain, shifted)).astype(np.int64)


def _projections(dim: int, tables: int, blocks: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((tables, blocks * 8, dim))


def _fold(points: np.ndarray, table: int, dim: int) -> np.ndarray:
    """64-bit keys of cells (rows of integers)."""
    key = np.full(len(points), (table + 1) * 0x9E3779B97F4A7C15 + dim & (1 << 64) - 1, dtype=np.uint64)
    for column in points.T:
        key = (key ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def cells(unit: np.ndarray, tables: int, blocks: int, scale: float, probes: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(table, key of the own cell, keys of the probed cells) of unit vectors.

    Probed are the neighbours nearest to the projected point: each moves one of the cell's E8 points by a shortest vector.
    """
    dim = unit.shape[1]
    moves = e8_neighbours()
    for table, matrix in enumerate(_projections(dim, tables, blocks, seed)):
        place = unit @ matrix.T * scale
        own = np.concatenate([e8_decode(place[:, 8 * b : 8 * b + 8]) for b in range(blocks)], axis=1)
        # |p - (c + m)|^2 - |p - c|^2 = |m|^2 - 2 (p - c) m, and all m are of one length: the nearest have the largest product
        gain = np.concatenate(
            [(place[:, 8 * b : 8 * b + 8] - own[:, 8 * b : 8 * b + 8] / 2) @ moves.T for b in range(blocks)], axis=1
        )
        chosen = np.argpartition(-gain, min(probes, gain.shape[1] - 1), axis=1)[:, :probes]
        probed = []
        for column in chosen.T:
            cell = own.copy()
            block, move = column // len(moves), column % len(moves)
            for b in range(blocks):
                hit = block == b
                cell[hit, 8 * b : 8 * b + 8] += moves[move[hit]]
            probed.append(_fold(cell, table, dim))
        yield table, _fold(own, table, dim), np.stack(probed, axis=1) if probed else np.empty((len(unit), 0), np.int64)


def _unit_vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: row numbers and unit vectors of the usable rows."""
    by_dim: dict[int, list[int]] = {}
    rows = column.to_pylist()
    for at, row in enumerate(rows):
        if row and None not in row:
            by_dim.setdefault(len(row), []).append(at)
    out = {}
    for dim, places in by_dim.items():
        block = np.array([rows[p] for p in places], dtype=np.float64)
        size = np.abs(block).max(axis=1)
        usable = np.isfinite(size) & (size > 0)
        block = block[usable] / size[usable, None]
        out[dim] = np.array(places)[usable], block / np.linalg.norm(block, axis=1, keepdims=True)
    return out


def near_links(
    vectors: DataFrame,
    min_cosine: float = MIN_COSINE,
    tables: int = TABLES,
    blocks: int = BLOCKS,
    scale: float = SCALE,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """(a, b, cosine), a < b: linked pairs among the rows (cls, unit) of distinct directions."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, unit in _unit_vectors(batch.column(1)).values():
                ids = batch.column(0).take(pa.array(places)).to_numpy(zero_copy_only=False)
                for _, own, probed in cells(unit, tables, blocks, scale, probes, seed):
                    keys = np.concatenate([own, probed.ravel()])
                    who = np.concatenate([ids, np.repeat(ids, probed.shape[1])])
                    kind = np.arange(len(keys)) >= len(own)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(who), pa.array(kind)], ["key", "cls", "probe"])

    entries = materialise(vectors.select("cls", "unit").mapInArrow(index, "key long, cls long, probe boolean"), "lattice-cells")
    stored = entries.where("not probe").select("key", F.col("cls").alias("x"))
    asked = entries.select("key", F.col("cls").alias("y"), "probe")
    meet = asked.join(stored, "key").where("x <> y and (probe or x < y)")
    pairs = materialise(meet.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "lattice-pairs")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = pd.DataFrame({"a": batch.column(0).to_numpy(), "b": batch.column(1).to_numpy()})
            left, right = (np.stack(batch.column(c).to_numpy(zero_copy_only=False)) if len(batch) else np.empty((0, 1)) for c in (2, 3))
            frame["cosine"] = np.einsum("ij,ij->i", left, right)
            yield pa.RecordBatch.from_pandas(frame[frame["cosine"] >= min_cosine], preserve_index=False)

    left = vectors.select(F.col("cls").alias("a"), F.col("unit").alias("u"))
    right = vectors.select(F.col("cls").alias("b"), F.col("unit").alias("v"))
    with_left = materialise(pairs.join(left, "a"), "lattice-left")
    both = with_left.join(right, "b").where("size(u) = size(v)").select("a", "b", "u", "v")
    return both.mapInArrow(verify, "a long, b long, cosine double")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", min_cosine: float = MIN_COSINE, **params) -> DataFrame:
    """(key, n_links, component_id, kept): vectors linked by cosine, one row per row of ``vectors``.

    Rows of one direction (equal unit vectors) are folded to a class first, so thousands of exact copies are one entry of
    the index; they link with each other and with all the class links with.  Each class is put in its own lattice cell in
    every table and looks up the nearest neighbouring cells; pairs that meet are compared once, in double precision, and
    only true links are kept.  A cell's rows meet by an equi-join that AQE splits; links of a crowd of different vectors
    are all counted, since ``n_links`` reports them.  Recall is tested against brute force.

    Null, empty and zero vectors and such with null or non-finite components have no links and are their own component;
    vectors of different lengths never link.  Repeated rows are kept (equal keys count as separate vectors, and share the
    smallest id); null keys link like others, and a group without any id has component null.  An empty table gives no rows.
    """

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit: list = [None] * len(batch)
            for places, block in _unit_vectors(batch.column(1)).values():
                for place, row in zip(places, block):
                    unit[place] = row
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(unit, pa.list_(pa.float64()))], ["id", "unit"])

    thin = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = thin.mapInArrow(normal, "id long, unit array<double>").withColumn("cls", F.xxhash64("unit"))
    rows = materialise(rows, "vectors")
    usable = rows.where("unit is not null")
    classes = usable.groupBy("cls").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.any_value("unit").alias("unit"))
    classes = materialise(classes, "vector-classes")
    links = materialise(near_links(classes, min_cosine, **params).select("a", "b"), "vector-links")
    labels = component_labels(links).select(F.col("id").alias("cls"), F.col("component_id").alias("root"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("cls").alias("b"), "n")
    degree = materialise(both.join(sizes, "b").groupBy("a").agg(F.sum("n").alias("others")), "vector-degree")
    rooted = classes.join(labels, "cls", "left").join(degree.withColumnRenamed("a", "cls"), "cls", "left")
    rooted = materialise(
        rooted.select("cls", "rep", F.coalesce("root", "cls").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links")),
        "vector-roots",
    )
    least = materialise(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "vector-least")
    named = materialise(rooted.join(least, "root").select(F.col("cls").alias("of"), "component_id", "n_links"), "vector-named")
    found = rows.join(named, F.when(F.col("unit").isNotNull(), F.col("cls")) == F.col("of"), "left")
    component = F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
usable AS (
  SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    AND list_dot_product(a.e, b.e) / (a.size * b.size) >= {MIN_COSINE}),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN degree USING (vec_id)"""

QUERIES = {"op1_near_vectors": op1_near_vectors}
ORACLE = {"op1_near_vectors": SQL}
