"""Hard-negative mining: exact inner products by subset-sum tables of the anchors, indexed with the candidates' bit planes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoledger.llm.common import ship_with_tasks
from geoledger.llm.vectors import integer_matrices, usable
from geoledger.sources.scratch import materialise

POSITIVES = 5
NEGATIVES = 5
#: A negative's score is at least LEAST[0] / LEAST[1] of the positive's and at most as large.
LEAST = (80, 100)
GROUP = 8  # dimensions of one table index
CANDIDATES = 16_384  # rows of a block of candidates
ANCHORS = 2_048  # rows of a block of anchors, on average
SLICE = 1_024  # candidates scored at once
PARTITIONS = 4_096  # tasks of one pass, at most

ship_with_tasks(__name__)


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """uint8 (bits, groups, rows): byte j of plane k packs bit k of eight neighbouring dimensions, two's complement."""
    n, dim = rows.shape
    padded = np.zeros((n, -(-dim // GROUP) * GROUP), np.int64)
    padded[:, :dim] = rows
    bits = 1 + max(int(rows.max(initial=0)), -1 - int(rows.min(initial=0))).bit_length()
    planes = [np.packbits(padded >> k & 1, axis=1, bitorder="little").T for k in range(bits)]
    return np.ascontiguousarray(np.stack(planes))


def subset_sums(anchors: np.ndarray, bits: int) -> np.ndarray:
    """(groups, 256, anchors): for every eight dimensions the sums of all subsets of the anchor's components.

    32-bit numbers where no partial score can leave them, else 64-bit ones.
    """
    n, dim = anchors.shape
    padded = np.zeros((n, -(-dim // GROUP) * GROUP), np.int64)
    padded[:, :dim] = anchors
    largest = int(np.abs(anchors).sum(axis=1).max(initial=0)) << bits
    table = np.zeros((padded.shape[1] // GROUP, 1 << GROUP, n), np.int32 if largest < 1 << 31 else np.int64)
    for group in range(len(table)):
        for j in range(GROUP):
            table[group, 1 << j : 2 << j] = table[group, : 1 << j] + padded[:, group * GROUP + j].astype(table.dtype)
    return table


def scores(table: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors) inner products: for every plane the looked-up sums, shifted and added from the top bit down."""
    total = np.zeros((planes.shape[2], table.shape[2]), table.dtype)
    for k in range(len(planes) - 1, -1, -1):
        total <<= 1
        for group in range(len(table)):
            found = table[group].take(planes[k, group], axis=0)
            if k == len(planes) - 1:  # the sign plane weighs negative
                total -= found
            else:
                total += found
    return total


def leading(groups: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group, higher scores first, ties by smaller id."""
    order = np.lexsort((ids, -score.astype(np.int64), groups))
    groups = groups[order]
    new = np.append(True, groups[1:] != groups[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(groups)), 0))
    return order[np.arange(len(groups)) - start < k]


def pack_candidates(df: DataFrame, key: str, label: str, vector: str, rows_per_block: int = CANDIDATES) -> DataFrame:
    """One row per block of usable vectors of one length, in order of label and key: (dim, block, n, ids, labels, planes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(dim: int, parts: list) -> pa.RecordBatch:
            ids, labels, rows = (np.concatenate(column) for column in zip(*parts))
            order = np.lexsort((ids, labels))
            planes = bit_planes(rows[order])
            values = [dim, len(ids), len(planes), ids[order].tobytes(), labels[order].tobytes(), planes.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], ["dim", "n", "bits", "ids", "labels", "planes"])

        held: dict[int, list] = {}
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy() for i in (0, 1))
            for dim, (at, rows) in integer_matrices(batch.column(2)).items():
                for begin in range(0, len(at), rows_per_block):
                    some = slice(begin, begin + rows_per_block)
                    if sum(len(part[0]) for part in held.get(dim, [])) + len(at[some]) > rows_per_block:
                        yield block(dim, held.pop(dim))
                    held.setdefault(dim, []).append((ids[at[some]], labels[at[some]], rows[some]))
        for dim, parts in held.items():
            yield block(dim, parts)

    schema = "dim long, n long, bits long, ids binary, labels binary, planes binary"
    packed = df.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v")).mapInArrow(run, schema)
    return packed.withColumn("block", F.monotonically_increasing_id())


def _scored(anchors: DataFrame, packed: DataFrame, n_anchors: int, n_blocks: int, body: Callable, schema: str) -> DataFrame:
    """``body(anchors, candidate block)`` for every block of anchors and block of candidates.

    Both sides are repeated once per block of the other and meet on the pair of block numbers.
    """
    groups = max(1, -(-n_anchors // ANCHORS))
    tasks = max(1, min(groups * n_blocks, PARTITIONS))
    left = anchors.withColumn("i", F.pmod(F.xxhash64("place"), F.lit(groups)).cast("int"))
    left = left.join(packed.select("dim", F.col("block").alias("of_block")), "dim").repartition(tasks, "i", "of_block")
    right = packed.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartition(tasks, "i", "block")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [field.split()[0] for field in schema.split(", ")]
        if not len(left) or not len(right):
            return pa.Table.from_arrays([pa.array([], pa.int64())] * len(names), names)
        block = {name: right.column(name)[0].as_py() for name in ("dim", "n", "bits", "ids", "labels", "planes")}
        ids, labels = (np.frombuffer(block[name], np.int64) for name in ("ids", "labels"))
        planes = np.frombuffer(block["planes"], np.uint8).reshape(block["bits"], -1, block["n"])
        order = np.argsort(left.column("label").to_numpy(), kind="stable")
        left = left.take(pa.array(order)).combine_chunks()
        ((_, rows),) = integer_matrices(left.column("v").combine_chunks()).values()
        columns = {name: left.column(name).to_numpy() for name in ("place", "id", "label")}
        found = body(columns, left, rows, ids, labels, planes)
        return pa.Table.from_arrays([pa.array(column.astype(np.int64)) for column in found], names)

    return left.groupBy("i", "of_block").cogroup(right.groupBy("i", "block")).applyInArrow(run, schema)


def _positives(k: int) -> Callable:
    """Best ``k`` of the anchor's own label in a block; only rows of that label are scored."""

    def body(columns, left, rows, ids, labels, planes) -> list[np.ndarray]:
        found: list[list[np.ndarray]] = [[], [], []]
        for label in np.intersect1d(columns["label"], labels).tolist():
            mine = slice(*np.searchsorted(columns["label"], [label, label + 1]))
            low, high = np.searchsorted(labels, [label, label + 1])
            table = subset_sums(rows[mine], len(planes))
            anchor_ids = columns["id"][mine]
            for at in range(low, high, SLICE):
                some = slice(at, min(at + SLICE, high))
                score, n = scores(table, planes[:, :, some]), some.stop - at
                least = np.partition(score, n - k - 1, axis=0)[n - k - 1] if n > k + 1 else score.min(axis=0)
                row, anchor = np.nonzero((score >= least) & (ids[some, None] != anchor_ids))
                value, candidate = score[row, anchor].astype(np.int64), ids[some][row]
                best = leading(anchor, value, candidate, k)
                for column, more in zip(found, (anchor[best] + mine.start, value[best], candidate[best])):
                    column.append(more)
        anchor, value, candidate = (np.concatenate([np.empty(0, np.int64), *column]) for column in found)
        best = leading(anchor, value, candidate, k)
        anchor = anchor[best]
        return [columns["place"][anchor], columns["id"][anchor], candidate[best], value[best]]

    return body


def _negatives(k: int, least: tuple[int, int]) -> Callable:
    """Best ``k`` of other labels in a block for every positive of an anchor, inside the positive's window of scores."""
    share, whole = least

    def body(columns, left, rows, ids, labels, planes) -> list[np.ndarray]:
        pairs = left.column("positives").combine_chunks()  # (rank, score) of the positives, in ranks 1, 2, ...
        counts = np.diff(pairs.offsets.to_numpy())
        flat = pairs.flatten()
        rank, top = (flat.field(name).to_numpy() for name in ("rank", "score"))
        owner = np.repeat(np.arange(len(counts)), counts)
        low = -(-share * top // whole)
        # an anchor's candidates lie between its lowest and highest window end
        lowest, highest = np.full(len(counts), np.iinfo(np.int64).max), np.full(len(counts), np.iinfo(np.int64).min)
        np.minimum.at(lowest, owner, low)
        np.maximum.at(highest, owner, top)
        table = subset_sums(rows, len(planes))
        found: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(ids), SLICE):
            some = slice(at, at + SLICE)
            score = scores(table, planes[:, :, some])
            near = (score >= lowest) & (score <= highest)
            near &= labels[some, None] != columns["label"]
            row, anchor = np.nonzero(near)
            value, candidate = score[row, anchor].astype(np.int64), ids[some][row]
            for place in range(int(counts.max(initial=0))):  # the anchors' first positives, their second ones, ...
                has = counts[anchor] > place
                pair = (np.cumsum(counts) - counts)[anchor[has]] + place
                inside = (value[has] >= low[pair]) & (value[has] <= top[pair])
                pair, worth, other = pair[inside], value[has][inside], candidate[has][inside]
                best = leading(pair, worth, other, k)
                for column, more in zip(found, (pair[best], worth[best], other[best])):
                    column.append(more)
        pair, value, candidate = (np.concatenate([np.empty(0, np.int64), *column]) for column in found)
        best = leading(pair, value, candidate, k)
        pair = pair[best]
        return [columns["place"][owner[pair]], rank[pair], candidate[best], value[best]]

    return body


def _first(df: DataFrame, groups: list[str], other: str, k: int) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc(other))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: tuple[int, int] = LEAST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the anchors among all rows.

    A score is the exact inner product of floor(256 * x).  An anchor's positives are its first ``positives`` rows of its
    own label, a positive's negatives the first ``negatives`` rows of other labels whose score is at most the positive's and at least
    ``least`` of it; higher scores first, ties by smaller key.  Every anchor is scored against every row: first against
    those of its label, then, when its positives are known, against the others.  Blocks send their own
    best few, so that what is ordered grows with the blocks and not with the rows.

    Rows with a null key or label, and vectors that are null, empty or hold a component that is null, not finite or at
    least 65536 in size, take no part.  Vectors of unlike length are not compared.  A repeated key is never its own partner; every
    repeated row counts as a row, so an anchor that is there twice has its rows twice.  A positive with a negative
    score has no negatives.  An empty table gives no rows; other columns are ignored, whatever their names.
    """
    rows = df.where(usable(vector) & F.col(key).isNotNull() & F.col(label).isNotNull())
    anchors = rows.where(is_anchor).select(
        F.monotonically_increasing_id().alias("place"),
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.size(vector).cast("long").alias("dim"),
        F.col(vector).alias("v"),
    )
    anchors = materialise(anchors, "anchors")
    thin = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("v"))
    packed = materialise(pack_candidates(thin, "id", "label", "v"), "bit-planes")
    sizes = anchors.count(), packed.count()

    near = _scored(anchors, packed, *sizes, _positives(positives), "place long, anchor_id long, positive_id long, score long")
    known = materialise(_first(near, ["place"], "positive_id", positives), "positives")
    listed = known.groupBy("place").agg(F.array_sort(F.collect_list(F.struct(F.col("rank").cast("long").alias("rank"), "score"))).alias("positives"))
    ready = materialise(anchors.join(listed, "place"), "anchors-with-positives")
    hard = _scored(ready, packed, *sizes, _negatives(negatives, least), "place long, of long, negative_id long, score long")
    hard = _first(hard, ["place", "of"], "negative_id", negatives).withColumnRenamed("score", "negative_score")
    known = known.select("place", F.col("rank").cast("long").alias("of"), "anchor_id", "positive_id", F.col("score").alias("positive_score"))
    return hard.join(known, ["place", "of"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)


SQL = f"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
    CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM r AS a JOIN r AS c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LEAST[0]} * positive_score <= {LEAST[1]} * score AND score <= positive_score
QUALIFY rank <= {NEGATIVES}"""

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLE = {"op13_hard_negatives": SQL}
