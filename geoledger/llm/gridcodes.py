"""Product codes of vectors: nearest codebook entries found through memoised grid cells."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from geoledger.llm.common import ship_with_tasks, worker_store
from geoledger.llm.vectors import integer_matrices, usable
from geoledger.sources.scratch import materialise

PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: About as many grid cells lie in the box around a codebook.
CELLS = 4096
#: Cells a worker remembers before it starts anew.
MEMO = 200_000
#: Distances evaluated at once.
BATCH = 1 << 20

ship_with_tasks(__name__)


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` are whole numbers; every part has the same number of entries and components."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def cell_side(book: np.ndarray, cells: int = CELLS) -> int:
    """Side of the grid cells of one part: the codebook's extent over the d-th root of ``cells``."""
    steps = max(1, round(cells ** (1 / book.shape[1])))
    return max(1, -(-int((book.max(axis=0) - book.min(axis=0)).max()) // steps))


def undominated(book: np.ndarray, cells: np.ndarray, side: int) -> np.ndarray:
    """(cell, entry): the entry can be the nearest of some whole point of the cell.

    An entry is dominated where its least distance to the box exceeds the largest distance of some other entry; equal
    ones stay, since the lower index wins a tie.
    """
    low = (cells * side)[:, None, :]
    high = low + (side - 1)
    least = (np.maximum(np.maximum(low - book, book - high), 0) ** 2).sum(axis=2)
    most = (np.maximum(np.abs(book - low), np.abs(book - high)) ** 2).sum(axis=2)
    return least <= most.min(axis=1, keepdims=True)


def distinct_rows(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and which of them each row is; found by hash, checked by value."""
    factors = np.random.default_rng(cells.shape[1]).integers(0, 1 << 62, cells.shape[1], np.uint64) * np.uint64(2) + np.uint64(1)
    mixed = (cells.astype(np.uint64) * factors).sum(axis=1, dtype=np.uint64)
    _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
    if (cells[first][which] == cells).all():
        return cells[first], which
    rows, which = np.unique(cells, axis=0, return_inverse=True)
    return rows, which.ravel()


def nearest(points: np.ndarray, book: np.ndarray, memo: dict, name: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point, the lower of equal ones, and the squared distance.

    ``memo`` keeps the undominated entries of every cell met so far; only those are evaluated.
    """
    side = cell_side(book)
    cells, which = distinct_rows(points // side)
    keys = [(name, row.tobytes()) for row in cells]
    new = [n for n, key in enumerate(keys) if key not in memo]
    if len(memo) + len(new) > MEMO:
        memo.clear()
        new = list(range(len(keys)))
    step = max(1, BATCH // book.size)
    for at in range(0, len(new), step):
        some = new[at : at + step]
        for n, row in zip(some, undominated(book, cells[some], side)):
            memo[keys[n]] = np.flatnonzero(row)
    lists = [memo[key] for key in keys]
    sizes = np.array([len(entries) for entries in lists], dtype=np.int64)
    begins, listed = np.cumsum(sizes) - sizes, np.concatenate(lists)
    codes, errors = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    for at in range(0, len(points), step):
        cell = which[at : at + step]
        count = sizes[cell]
        ends = np.cumsum(count)
        place = np.arange(ends[-1]) + np.repeat(begins[cell] - (ends - count), count)
        entry = listed[place]
        off = np.repeat(points[at : at + step], count, axis=0) - book[entry]
        distance = (off * off).sum(axis=1)
        best = np.minimum.reduceat(distance, ends - count)
        errors[at : at + step] = best
        codes[at : at + step] = np.minimum.reduceat(np.where(distance == np.repeat(best, count), entry, len(book)), ends - count)
    return codes, errors


def assigned(rows: np.ndarray, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, points, codes, squared distances) of a block of vectors."""
    parts, _, width = books.shape
    store = worker_store("grid-cells")
    digest = hashlib.sha256(books.tobytes()).hexdigest()
    if store.get("books") != digest:  # one set of codebooks is in use at a time
        store.update(books=digest, memo={})
    for part in range(parts):
        points = rows[:, part * width : (part + 1) * width]
        yield part, points, *nearest(points, books[part], store["memo"], part)


def same_length(df: DataFrame, vector: str, parts: int, key: str) -> tuple[DataFrame, int]:
    """Usable vectors of the length that the smallest key has, and that length (0: there are none)."""
    kept = df.where(usable(vector) & (F.size(vector) % parts == 0))
    first = kept.orderBy(F.asc_nulls_last(key), vector).select(F.size(vector).alias("n")).first()
    return (kept.where(F.size(vector) == first["n"]), first["n"]) if first else (kept, 0)


def train_codebooks(
    df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, key: str = "vec_id", vector: str = "embedding"
) -> Codebooks | None:
    """Codebooks by ``rounds`` of assignment and averaging over all vectors; None without any usable one.

    They start as the parts of the ``entries`` smallest keys (nulls last, equal keys by vector).  Every task sends one row per
    part and entry, so what the driver takes in is bounded by the size of the codebooks.  An entry becomes the
    componentwise floor of its parts' mean; one without parts stays.
    """
    kept, dim = same_length(df, vector, parts, key)
    if not dim:
        return None
    thin = kept.select(F.col(vector).alias("v"), F.col(key).alias("k"))
    seeds = thin.orderBy(F.asc_nulls_last("k"), "v").limit(entries).select("v").toArrow().column("v").combine_chunks()
    ((_, start),) = integer_matrices(seeds).values()
    width = dim // parts
    books = np.ascontiguousarray(start.reshape(len(start), parts, width).transpose(1, 0, 2))

    def sums(books: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for batch in batches:
                for _, rows in integer_matrices(batch.column(0)).values():
                    for part, points, codes, _ in assigned(rows, books):
                        count[part] += np.bincount(codes, minlength=len(count[part]))
                        np.add.at(total[part], codes, points)
            part, entry = np.nonzero(count)
            found = [part.astype(np.int32), entry.astype(np.int32), count[part, entry], *(total[part, entry].T)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["part", "entry", "n", *names])

        return run

    names = [f"s{i}" for i in range(width)]
    schema = "part int, entry int, n long, " + ", ".join(f"{name} long" for name in names)
    for _ in range(rounds):
        found = thin.select("v").mapInArrow(sums(books), schema).groupBy("part", "entry")
        books = books.copy()
        for row in found.agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in names]).collect():
            books[row["part"], row["entry"]] = [row[name] // row["n"] for name in names]
    return Codebooks(books)


def encode(df: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """Columns of ``df`` plus ``codes`` (array<int>) and ``part_errors`` (array<long>, squared distances) of the vectors that fit.

    Left out are vectors that are null, empty or of another length than the codebooks, and those with a component that
    is null, not finite or at least 65536 in size.  Columns named like the two new ones are replaced; repeated rows
    and null keys are kept; an empty table gives no rows.  Every component x counts as floor(256 * x).
    """
    parts, _, width = books.entries.shape
    kept = df.drop("codes", "part_errors").where(usable(vector) & (F.size(vector) == parts * width))
    at = kept.columns.index(vector)
    table = books.entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = np.empty((len(batch), parts), np.int32), np.empty((len(batch), parts), np.int64)
            for _, rows in integer_matrices(batch.column(at)).values():
                for part, _, found, error in assigned(rows, table):
                    codes[:, part], errors[:, part] = found, error
            ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * parts)
            lists = [pa.ListArray.from_arrays(ends, pa.array(block.ravel())) for block in (codes, errors)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "codes", "part_errors"])

    extra = [StructField("codes", ArrayType(IntegerType())), StructField("part_errors", ArrayType(LongType()))]
    return kept.mapInArrow(run, StructType([*kept.schema.fields, *extra]))


def op11_grid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    books = train_codebooks(vectors)
    if books is None:
        none = vectors.where("false").select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none.withColumns({"label_error": F.col("error"), "codebooks_sha256": F.lit("")})
    coded = encode(vectors, books).select(
        "vec_id",
        "label",
        F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "").alias("code"),
        F.aggregate("part_errors", F.lit(0).cast("long"), lambda total, e: total + e).alias("error"),
    )
    coded = materialise(coded, "grid-codes")
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))  # one row per label; Spark checks its size
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def _sql() -> str:
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def assign(number: int) -> str:
        return (
            f"a{number} AS MATERIALIZED (SELECT n, p, x, arg_min({{'e': e, 'd': d}}, {{'d': d, 'e': e}}) AS best FROM"
            f" (SELECT n, p, x, e, {distance} AS d FROM parts JOIN b{number} USING (p)) GROUP BY n, p, x)"
        )

    def average(number: int) -> str:
        return (
            f"b{number} AS MATERIALIZED (SELECT p, e, coalesce(m, c) AS c FROM b{number - 1} LEFT JOIN ("
            f"SELECT p, e, list(m ORDER BY i) AS m FROM (SELECT p, best.e AS e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m"
            f" FROM a{number - 1}, range(1, 1 + (SELECT max(len(x)) FROM parts)) AS g(i) GROUP BY ALL) GROUP BY p, e) USING (p, e))"
        )

    return f"""
    WITH kept AS (
      SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (
      SELECT n, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) AS g(p)),
    b0 AS MATERIALIZED (SELECT p, n - 1 AS e, x AS c FROM parts WHERE n <= {ENTRIES}),
    {assign(0)}, {average(1)}, {assign(1)}, {average(2)}, {assign(2)},
    whole AS (SELECT n, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
      FROM a2 GROUP BY n),
    books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
    FROM whole JOIN kept USING (n), books"""


QUERIES = {"op11_grid_codes": op11_grid_codes}
ORACLE = {"op11_grid_codes": _sql()}
