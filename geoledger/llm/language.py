"""Scoring by cross-entropy difference: matched n-gram models of a target and a background over one vocabulary."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm.common import ship_with_tasks
from geoledger.sources.scratch import materialise

#: Share of the pair estimate; the rest is the word's own.
PAIR_WEIGHT = 0.6
#: Distinct words a task holds before it gives their counts on.
HELD_WORDS = 200_000
#: Words of the texts that one task numbers together, and of those stored in one row.
CHUNK_WORDS = 4_000_000
PART_WORDS = 250_000
#: Words per range of keys, and the least number of ranges.
RANGE_WORDS = 1_250_000
RANGES = 128
UNKNOWN, START = 0, 1
#: White space is in no word, so these stand for the start of a text and for a word outside a given vocabulary.
START_WORD, UNKNOWN_WORD = " ", "  "

ship_with_tasks(__name__)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def word_classes(words: int, cells: int) -> np.ndarray:
    """Class of each word id, for models of a bounded size; no query uses them (ids are in order of frequency), so that every pair of classes has a cell of its own.

    Where there is room each word is a class.  Otherwise the most frequent words fill three quarters of the classes, one
    each, and the others are dealt to the rest.
    """
    ids, room = np.arange(words), isqrt(cells)
    if words <= room:
        return ids
    single = room * 3 // 4
    return np.where(ids < single, ids, single + (ids - single) % (room - single))


def vocabulary(background: DataFrame, size: int, text: str = "text") -> list[str]:
    """The most frequent words of all texts, at most ``size``, by falling count and then by word.

    Words enter by classes of like counts (one count up to 1024, then within a 64th of an octave), whole classes as long as
    they fit.  Only the class sizes and the words chosen come to the driver, however many words and partitions there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def given() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for value in batch.column(0):
                counts.update(words_of(value.as_py()))
                if len(counts) >= HELD_WORDS:
                    yield given()
        yield given()

    partial = background.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    totals = materialise(partial.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    rank = F.when(F.col("n") <= 1024, F.col("n")).otherwise((F.log2("n") * 64).cast("long") + 1024)
    classes = totals.groupBy(rank.alias("rank")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("rank")).collect()
    room, least = size, None
    for row in classes:
        room -= row["words"]
        if room < 0:
            break
        least = row["rank"]
    return [] if least is None else [r["word"] for r in sorted(totals.where(rank >= least).collect(), key=lambda r: (-r["n"], r["word"]))]


@dataclass(frozen=True)
class Shape:
    """What both models share: word ids, the class of each id, weight of pairs."""

    ids: dict[str, int]
    classes: np.ndarray
    pair_weight: float

    @property
    def n_classes(self) -> int:
        return int(self.classes.max()) + 1

    def encode(self, text: str | None) -> np.ndarray:
        get = self.ids.get
        return np.array([get(w, UNKNOWN) for w in words_of(text)], dtype=np.int64)

    def class_pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class before each word, and cell of the two classes."""
        after = self.classes[ids]
        before = np.concatenate([self.classes[[START]], after[:-1]])
        return before, before * self.n_classes + after


def estimates(shape: Shape, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word its own probability and that within its class, per class its count as first, per pair of classes its count."""
    single, first, pairs = counts
    members = np.bincount(shape.classes)
    totals = np.bincount(shape.classes, weights=single, minlength=len(members))
    own = (single + 1) / (single.sum() + len(single))
    return own, (single + 1) / (totals + members)[shape.classes], first, pairs


def losses(shape: Shape, model: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray) -> np.ndarray:
    """Negative natural logarithm of each word's probability after the word before it.

    The probability is that of its class after the class before it times its share of the class, mixed with its own; over
    the vocabulary it sums to one.
    """
    own, within, first, pairs = model
    before, cells = shape.class_pairs(ids)
    seen = first[before]
    paired = pairs[cells] / np.maximum(seen, 1) * within[ids]
    weight = np.where(seen > 0, shape.pair_weight, 0.0)
    return -np.log(weight * paired + (1 - weight) * own[ids])


def packed(*arrays: np.ndarray) -> bytes:
    """The arrays as one compressed value, bytes of like weight together."""
    import zstandard

    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def unpacked(body: bytes, *dtypes) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(body)
    at, out = 8 * len(dtypes), []
    for n, dtype in zip(np.frombuffer(raw, np.int64, len(dtypes)).tolist(), map(np.dtype, dtypes)):
        planes = np.frombuffer(raw, np.uint8, n * dtype.itemsize, at).reshape(dtype.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(dtype))
        at += n * dtype.itemsize
    return out


def word_keys(words: Iterable[str]) -> np.ndarray:
    """64-bit digest of each word."""
    return np.frombuffer(b"".join(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in words), np.uint64)


def pair_keys(keys: np.ndarray, numbers: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each word of texts laid end to end: number of the word before it (0, the start, for a first one) and 64-bit digest of the two."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0
    mixed = keys[before] * np.uint64(0x9E3779B97F4A7C15) + keys[numbers]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return before, mixed ^ (mixed >> np.uint64(31))


def numbered(texts: DataFrame, odd: int, known: Iterable[str] | None, key: str, text: str) -> DataFrame:
    """(chunk, part, n_words, ids, keys, body): texts as numbers of words in order of first sight within a chunk, all of one task.

    The chunk is odd or even as asked for; its first part has the digests of its words, the start of a text being number 0.
    With ``known`` all other words are one.
    """
    known = None if known is None else texts.sparkSession.sparkContext.broadcast(frozenset(known))
    names = ["chunk", "part", "n_words", "ids", "keys", "body"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, done = TaskContext.get().partitionId(), 0
        numbers: defaultdict[str, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        parts: list[tuple[list, list[int], list[np.ndarray]]] = []

        def begin() -> int:
            numbers.clear()
            parts.clear()
            numbers[START_WORD]
            return 0

        def rows() -> Iterator[pa.RecordBatch]:
            chunk = ((place << 24) + done) * 2 + odd
            for n, (ids, lengths, found) in enumerate(parts):
                body = packed(np.concatenate(found), np.array(lengths, np.int64))
                row = [chunk, n, sum(lengths), ids, b"" if n else packed(word_keys(numbers)), body]
                yield pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, kinds)], names)

        held = begin()
        room = 0
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(value.as_py())
                if known is not None:
                    words = [w if w in known.value else UNKNOWN_WORD for w in words]
                if room <= 0 or not parts:
                    parts.append(([], [], []))
                    room = PART_WORDS
                for column, of in zip(parts[-1], (name, len(words), np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))):
                    column.append(of)
                # an empty text counts too, so that a part has a bounded number of rows
                room -= len(words) + 1
                held += len(words) + 1
                if held >= CHUNK_WORDS:
                    yield from rows()
                    held, done = begin(), done + 1
        yield from rows()

    thin = texts.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return thin.mapInArrow(run, "chunk long, part int, n_words long, ids array<long>, keys binary, body binary")


def laid_out(parts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list, list[int]]:
    """Digests of a chunk's words, numbers of all its words, lengths and ids of its texts, texts before each part."""
    parts = parts.sort_by("part")
    numbers, lengths = (np.concatenate(x) for x in zip(*[unpacked(b.as_py(), np.uint32, np.int64) for b in parts["body"]]))
    (keys,) = unpacked(parts["keys"][0].as_py(), np.uint64)
    ids = parts["ids"].to_pylist()
    return keys, numbers, lengths, [i for part in ids for i in part], np.cumsum([0, *map(len, ids)]).tolist()


def own_counts(parts: pa.Table, flags: pa.Table, ranges: int) -> pa.Table:
    """(bucket, chunk, body): keys of a chunk's words and pairs and their counts in target and background, by range of keys."""
    chunk = parts["chunk"][0].as_py()
    keys, numbers, lengths, _, starts = laid_out(parts)
    near = np.full(len(lengths), chunk % 2 == 1)
    near[[starts[part] + place for part, place in zip(flags["part"].to_pylist(), flags["place"].to_pylist())]] = True
    before, mixed = pair_keys(keys, numbers, lengths)
    pairs, at = np.unique(mixed, return_inverse=True)
    order = np.argsort(keys)
    words, counts = keys[order], []
    for of in (np.repeat(near, lengths), np.full(len(numbers), chunk % 2 == 0)):
        counts.append(np.bincount(numbers[of], minlength=len(keys))[order].astype(np.uint32))
        counts.append(np.bincount(before[of], minlength=len(keys))[order].astype(np.uint32))
        counts.append(np.bincount(at[of], minlength=len(pairs)).astype(np.uint32))
    edges = np.array([(b << 64) // ranges for b in range(ranges)], np.uint64)
    cuts, pair_cuts = ([*np.searchsorted(k, edges).tolist(), len(k)] for k in (words, pairs))
    buckets, bodies = [], []
    for b in range(ranges):
        w, p = slice(cuts[b], cuts[b + 1]), slice(pair_cuts[b], pair_cuts[b + 1])
        if w.start < w.stop or p.start < p.stop:
            steps = [np.diff(k, prepend=np.uint64(0)) for k in (words[w], pairs[p])]
            buckets.append(b)
            bodies.append(packed(*steps, *(c[p if i % 3 == 2 else w] for i, c in enumerate(counts))))
    return pa.table({"bucket": pa.array(buckets, pa.int32()), "chunk": pa.array([chunk] * len(buckets), pa.int64()), "body": pa.array(bodies, pa.binary())})


def summed(table: pa.Table) -> pa.Table:
    """Over all chunks' rows of one range: in place of a chunk's own counts the totals of its keys, in the same order."""
    parts = [unpacked(body.as_py(), np.uint64, np.uint64, *[np.uint32] * 6) for body in table["body"]]
    answers: list[list[np.ndarray]] = [[] for _ in parts]
    sums = np.zeros((len(parts), 3), np.int64)
    for kind, columns in ((0, (2, 3, 5, 6)), (1, (4, 7))):
        own = [np.cumsum(part[kind]) for part in parts]
        found, at = np.unique(np.concatenate(own), return_inverse=True)
        totals = [np.bincount(at, weights=np.concatenate([part[c] for part in parts]), minlength=len(found)).astype(np.int64) for c in columns]
        for answer, place in zip(answers, np.split(at, np.cumsum([len(k) for k in own])[:-1])):
            answer += [total[place] for total in totals]
        if kind == 0:  # on one of the rows, so that their sum is right
            sums[0] = totals[0].sum(), totals[2].sum(), np.count_nonzero(totals[0] + totals[2])
    body = pa.array([packed(*answer) for answer in answers], pa.binary())
    return pa.table({"bucket": table["bucket"], "chunk": table["chunk"], "body": body, **{n: sums[:, i] for i, n in enumerate(("near", "far", "size"))}})


def pair_losses(own: np.ndarray, first: np.ndarray, paired: np.ndarray, pair_weight: float) -> np.ndarray:
    """Negative natural logarithm of the probability of a word after another: the pair's share of the first, mixed with the word's own."""
    weight = np.where(first > 0, pair_weight, 0.0)
    return -np.log(weight * (paired / np.maximum(first, 1)) + (1 - weight) * own)


def scored(parts: pa.Table, answers: pa.Table, totals: tuple[int, int, int], pair_weight: float) -> pa.Table:
    """Mean losses of a chunk's texts."""
    if not len(parts):
        parts, n, means = None, np.zeros(0, np.int64), [np.zeros(0)] * 2
        ids = []
    else:
        keys, numbers, n, ids, _ = laid_out(parts)
        bodies = [unpacked(b.as_py(), *[np.int64] * 6) for b in answers.sort_by("bucket")["body"]]
        single_near, first_near, single_far, first_far, near, far = (np.concatenate(x) for x in zip(*bodies))
        before, mixed = pair_keys(keys, numbers, n)
        _, once, at = np.unique(mixed, return_index=True, return_inverse=True)
        rank = np.empty(len(keys), np.int64)
        rank[np.argsort(keys)] = np.arange(len(keys))
        a, b = rank[before[once]], rank[numbers[once]]
        filled, means = n > 0, []
        for single, first, paired, words in ((single_near, first_near, near, totals[0]), (single_far, first_far, far, totals[1])):
            loss = pair_losses((single[b] + 1) / (words + totals[2]), first[a], paired, pair_weight)[at]
            mean = np.zeros(len(n))
            if filled.any():
                mean[filled] = np.add.reduceat(loss, (np.cumsum(n) - n)[filled]) / n[filled]
            means.append(mean)
    return pa.table({"id": pa.array(ids, pa.int64()), "n_words": n, "target_loss": means[0], "background_loss": means[1], "score": means[0] - means[1]})


def _scores(stored: DataFrame, flags: DataFrame, size: int | None, pair_weight: float, key: str) -> DataFrame:
    """Scores of the texts of even chunks; target are those of odd chunks and those that ``flags`` (chunk, part, place) names."""
    words = stored.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(RANGES, ceil(words / RANGE_WORDS))
    counted = stored.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(
        lambda parts, flagged: own_counts(parts, flagged, ranges), "bucket int, chunk long, body binary"
    )
    answers = counted.groupBy("bucket").applyInArrow(summed, "bucket int, chunk long, body binary, near long, far long, size long")
    answers = materialise(answers, "language-counts")
    near, far, found = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("near", "far", "size")]).first()
    totals = (near, far, (found if size is None else size) + 2)
    even = F.col("chunk") % 2 == 0
    texts, replies = stored.where(even), answers.where(even).select("chunk", "bucket", "body")
    result = texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        lambda parts, answers: scored(parts, answers, totals, pair_weight),
        "id long, n_words long, target_loss double, background_loss double, score double",
    )
    return result.withColumnRenamed("id", key)


def cross_entropy_difference(
    docs: DataFrame,
    target: DataFrame,
    size: int | None = None,
    pair_weight: float = PAIR_WEIGHT,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, n_words, target_loss, background_loss, score): mean losses per word and their difference, lower being closer to the target.

    Words are lower-cased and separated by white space.  Both models, of all texts of ``docs`` (the background) and of
    ``target``, count every word and every pair of words that follow each other; a word's probability is that of its pair
    mixed with its own, smoothed by one over the words of both, an unseen word and the start, so that it sums to one.  The
    estimate is the same at every size.  Only with ``size`` words are left out: all but the most frequent are then one word.

    Counts grow with the corpus and are never in one place.  A task numbers the words of a chunk of texts and stores them; a
    chunk sends the distinct keys of its words and pairs with its own counts, by ranges of keys, to where the chunks' counts
    are added up, and gets the totals of its keys back.  A word or pair is one entry per chunk, however common it is.  Keys
    are 64-bit digests: among 3 * 10^9 different pairs the chance that any two share one is about a fifth.

    Null, empty and blank texts have no words and the losses and score 0.  An empty target leaves its model uniform.  Null
    keys and repeated rows are kept, an empty table gives no rows, other columns are ignored.
    """
    known = None if size is None else vocabulary(docs, size, text)
    void = target.select(F.lit(None).cast("long").alias("id"), F.col(text).alias("text"))
    parts = [materialise(numbered(*of), "language-texts") for of in ((docs, 0, known, key, text), (void, 1, known, "id", "text"))]
    flags = docs.sparkSession.createDataFrame([], "chunk long, part int, place int")
    return _scores(parts[0].unionByName(parts[1]), flags, None if known is None else len(known), pair_weight, key)


def scores_by_keys(docs: DataFrame, keys: DataFrame, pair_weight: float = PAIR_WEIGHT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``cross_entropy_difference`` where the target are the texts of ``docs`` whose key is in ``keys``: only keys are joined, no text."""
    stored = materialise(numbered(docs, 0, None, key, text), "language-texts")
    places = stored.select("chunk", "part", F.posexplode("ids").alias("place", "id"))
    flags = places.join(keys.select(F.col(key).alias("id")).hint("merge"), "id", "left_semi")
    # new columns: those of ``stored`` are on the other side of the cogroup
    flags = flags.select(*[F.col(c).alias(f"{c}_") for c in ("chunk", "part", "place")]).toDF("chunk", "part", "place")
    return _scores(stored, flags, None, pair_weight, key)


def op4_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled good.  Labels grow with the documents, so the two are joined by exchange at every size."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return scores_by_keys(docs, good)


QUERIES = {"op4_language_scores": op4_language_scores}
ORACLE = {}
