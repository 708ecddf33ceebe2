"""SimHash near-dedup: fingerprints meet in an inverted index on bytes at positions, with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoledger.llm.common import ship_with_tasks, whole_text
from geoledger.llm.components import component_labels
from geoledger.sources.scratch import materialise

BYTES = 8
SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Bytes held by one posting key: longer keys make shorter postings and more of them.
POSTING_BYTES = 4
#: Shingles whose bits are unpacked at once.
BLOCK = 1 << 16

ship_with_tasks(__name__)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the whole text, as a signed integer."""
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(lower).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    width = min(words, len(tokens))
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = [0, *ends[: len(tokens) - width].tolist()]
    spans = zip(starts, ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, key: str = "doc_id", text: str = "text", with_digest: bool = False) -> DataFrame:
    """(id, fp) of every row, and with ``with_digest`` the SHA-256 of its text, by which a row finds its fingerprint again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(value.as_py(), words) for value in batch.column(1)]
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), pa.array(found, pa.int64())], [*kept, "fp"])

    columns = [F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")]
    if with_digest:
        return docs.select(*columns, _digest(text)).mapInArrow(run, "id long, digest binary, fp long")
    return docs.select(*columns).mapInArrow(run, "id long, fp long")


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(whole_text(text), 256)).alias("digest")


@cache
def posting_positions(max_bits: int, size: int = POSTING_BYTES) -> tuple[tuple[int, ...], ...]:
    """Sets of byte positions so that any ``BYTES - max_bits`` matching positions contain at least one of them (greedy cover)."""
    size = min(size, BYTES - max_bits)
    open_cases = set(combinations(range(BYTES), BYTES - max_bits))
    chosen = []
    while open_cases:
        best = max(combinations(range(BYTES), size), key=lambda s: sum(set(s) <= set(case) for case in open_cases))
        chosen.append(best)
        open_cases = {case for case in open_cases if not set(best) <= set(case)}
    return tuple(chosen)


def _mask(positions: tuple[int, ...]) -> int:
    """Signed 64-bit mask of the bytes at the positions."""
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def _matching(a: str, b: str) -> Column:
    """8-bit set of the byte positions at which two fingerprints agree."""
    differs = F.col(a).bitwiseXOR(F.col(b))
    equal = [F.when(differs.bitwiseAND(F.lit(_mask((p,)))) == 0, F.lit(1 << p)).otherwise(F.lit(0)) for p in range(BYTES)]
    total = equal[0]
    for term in equal[1:]:
        total = total + term
    return total


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct fingerprints in column ``fp`` that differ in at most ``max_bits`` bits.

    A pair within the distance agrees on at least ``8 - max_bits`` bytes.  Postings are kept per set of byte positions
    (``posting_positions``), chosen so that every such agreement holds one whole set.  Pairs meeting in a posting get
    their shared positional bytes tallied; those below the guaranteed minimum go, the rest are verified bit by bit.  A
    pair that meets in several postings counts in the first only, so that nothing has to be de-duplicated afterwards.
    Tally, order and distance are conditions of the join itself: it gives links, not candidates.  Needs max_bits < 8.
    """
    sets = posting_positions(max_bits)
    minimum = BYTES - max_bits
    first = [next((n for n, s in enumerate(sets) if all(m >> p & 1 for p in s)), -1) for m in range(256)]
    tallies = [bin(m).count("1") for m in range(256)]
    postings = F.array(*[F.struct(F.lit(n).alias("n"), F.col("fp").bitwiseAND(F.lit(_mask(s))).alias("key")) for n, s in enumerate(sets)])
    index = distinct.select("fp", F.explode(postings).alias("p")).select("fp", "p.n", "p.key")
    left, right = index.toDF("a", "n", "key"), index.toDF("b", "n2", "key2")
    same = (F.col("n") == F.col("n2")) & (F.col("key") == F.col("key2"))
    mask = _matching("a", "b")
    counted = F.element_at(F.lit(tallies), mask + 1) >= minimum
    only_first = F.element_at(F.lit(first), mask + 1) == F.col("n")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.join(right, same & (F.col("a") < F.col("b")) & near & counted & only_first).select("a", "b")


def simhash_groups(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, fingerprint, component_id, n_links): near-duplicate groups by fingerprint distance, one row per row of ``docs``.

    Equal fingerprints are folded before anything is compared (a group of thousands of copies is one entry of the
    index), linked ones are joined to components, and the component goes back to the rows by fingerprint, a join that AQE
    splits where one fingerprint holds most rows.  ``n_links`` counts the other distinct fingerprints linked directly.

    Null and empty texts, and texts of separators only, have fingerprint zero and are linked like any other.  Texts of
    fewer than ``words`` words have one shingle.  A null key gets its group's smallest id (null if there is none).
    Repeated rows are kept, an empty table gives no rows, other columns are ignored.
    """
    rows = materialise(fingerprints(docs, words, key, text), "simhash")
    named = fingerprint_classes(rows, max_bits)
    return rows.join(named, "fp").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links"
    )


def fingerprint_classes(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id, n_links) of the distinct fingerprints of (id, fp) rows.

    ``root`` names the group of linked fingerprints, ``component_id`` its smallest id; groups that share an id differ in their roots.
    """
    classes = materialise(rows.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-classes")
    links = materialise(fingerprint_links(classes.select("fp"), max_bits), "simhash-links")
    labels = component_labels(links).select(F.col("id").alias("fp"), F.col("component_id").alias("root"))
    both = links.select(F.col("a").alias("fp")).unionByName(links.select(F.col("b").alias("fp")))
    degree = both.groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    rooted = materialise(
        classes.join(labels, "fp", "left").join(degree, "fp", "left").select(
            "fp", "rep", F.coalesce("root", "fp").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")
        ),
        "simhash-roots",
    )
    least = materialise(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "simhash-least")
    return materialise(rooted.join(least, "root").select("fp", "root", "component_id", "n_links"), "simhash-named")


def keep_one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each near-duplicate group of ``docs``: the one with the smallest key, and of its rows with that key the first by text.

    Rows with one key and unlike texts are in different groups, and one of each stays.  Rows with a null key have no group name
    and are all kept.  Columns may have any names.
    """
    rows = materialise(fingerprints(docs, words, key, text, with_digest=True), "simhash-digests")
    named = fingerprint_classes(rows, max_bits).select("fp", "root", "component_id")
    first = rows.join(named, "fp").where("id = component_id").select("id", "digest", "root").distinct()
    whole = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("id"), _digest(text), F.col(text).alias("text"))
    # the row limit is taken in every task before the rows of one group meet
    place = F.row_number().over(Window.partitionBy("id", "root").orderBy("text"))
    one = whole.join(first, ["id", "digest"]).withColumn("place", place).where("place = 1")
    return one.select("row.*").unionByName(docs.where(F.col(key).isNull()))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_simhash": op5_simhash}
ORACLE = {}
