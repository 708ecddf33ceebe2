"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark; repeated windows merge into removal intervals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm.common import ship_with_tasks, whole_text, worker_store

#: Words of a window.
SIZE = 13
#: Words a task holds before it sends their distinct windows.
CHUNK_WORDS = 1_000_000
#: Bytes of text for one range of hashes.
BUCKET_BYTES = 6_000_000
#: Words whose hash a worker remembers.
MEMO = 250_000
BASE = 0x9E3779B97F4A7C15

ship_with_tasks(__name__)


class _Hashes(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    store = worker_store("word-hashes")
    known = store.setdefault("words", _Hashes())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def rabin_karp(words: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash modulo 2^64 of every ``size`` consecutive numbers: sum of words[i + j] * BASE^(size - 1 - j).

    Two windows that differ in one word never agree.  The value is what the hash rolls to from window to window; here
    all windows take one word more at a time.
    """
    n = max(len(words) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out *= np.uint64(BASE)
        out += words[j : j + n]
    return out


def text_words(text: bytes | None) -> list[bytes]:
    """Maximal runs of bytes other than 0x20 and 0x09 to 0x0D, which is what ``bytes.split`` splits at."""
    return (text or b"").split()


def spans(repeated: np.ndarray, size: int) -> np.ndarray:
    """Maximal intervals [start, end) covered by the windows that start where ``repeated`` is true, as rows."""
    starts = np.flatnonzero(repeated)
    if not len(starts):
        return np.empty((0, 2), np.int64)
    breaks = np.flatnonzero(np.diff(starts) > size)  # windows that touch are one interval
    return np.stack([starts[np.append(0, breaks + 1)], starts[np.append(breaks, len(starts) - 1)] + size], axis=1)


def _blob(docs: np.ndarray, h: np.ndarray) -> tuple[bytes, bytes]:
    """Windows in ascending order of document: the documents' differences in as few bytes as they need, and the hashes."""
    steps = np.diff(docs, prepend=docs[:1])
    width = next(kind for kind in (np.uint8, np.uint16, np.uint32, np.int64) if steps.max() <= np.iinfo(kind).max)
    return docs[:1].tobytes() + steps.astype(width).tobytes(), h.tobytes()


def _opened(docs: bytes, h: bytes) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.frombuffer(h, np.uint64)
    width = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}[(len(docs) - 8) // len(hashes)]
    return np.frombuffer(docs, np.int64, 1) + np.cumsum(np.frombuffer(docs, width, offset=8), dtype=np.int64), hashes


def _chunk(rows: list[tuple[int, np.ndarray]], size: int, buckets: int) -> Iterator[tuple[int, bool, bytes, bytes]]:
    """(bucket, settled, documents, hashes) of one chunk of documents, one row per bucket of windows.

    Of every window the chunk holds, its smallest document goes on, to be compared with other chunks.  Where a larger
    document of the chunk holds it too, that is settled here; such rows only pass through, by any bucket.
    """
    rows.sort(key=lambda row: row[0])
    hashes = [rabin_karp(words, size) for _, words in rows]
    h = np.concatenate(hashes)
    docs = np.repeat(np.array([doc for doc, _ in rows], np.int64), [len(x) for x in hashes])
    distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
    least = docs[first]
    later = np.flatnonzero(docs > least[which])
    # rows ascend by document, so that equal (document, window) pairs can be told by one stable sort of the windows
    later = later[np.argsort(which[later], kind="stable")]
    fresh = np.ones(len(later), bool)
    fresh[1:] = (which[later][1:] != which[later][:-1]) | (docs[later][1:] != docs[later][:-1])
    later = np.sort(later[fresh])
    for at in range(0, len(later), 1 << 14):
        some = later[at : at + (1 << 14)]
        yield int(docs[some[-1]]) % buckets, True, *_blob(docs[some], h[some])
    bucket = _bucket(distinct, buckets)
    order = np.lexsort((least, bucket))
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
    for low, high in zip(np.append(0, ends[:-1]), ends):
        some = order[low:high]
        yield int(bucket[some[0]]), False, *_blob(least[some], distinct[some])


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _later(blobs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows of one bucket: (documents, hashes) where a smaller document has the window too."""
    docs, h = (np.concatenate(column) for column in zip(*blobs))
    order = np.lexsort((docs, h))
    docs, h = docs[order], h[order]
    new = np.append(True, h[1:] != h[:-1])
    later = docs > docs[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
    return docs[later], h[later]


def repeated_windows(docs: DataFrame, size: int = SIZE, key: str = "doc_id", text: str = "text", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(doc, h): windows, by 64-bit hash, that also start in a document with a smaller key.

    Tasks send each window once per chunk of about ``chunk_words`` words, with the smallest document of the chunk that has
    it, so a passage of a third of all documents is one entry per chunk.  Windows meet by ranges of their hash, whose number
    grows with the bytes of the texts, and travel packed; an entry takes nine to ten bytes.
    """
    thin = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc"), whole_text(text).cast("binary").alias("text"))
    total = thin.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, total // BUCKET_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(rows: list) -> Iterator[pa.RecordBatch]:
            for bucket, settled, found, h in _chunk(rows, size, buckets) if rows else ():
                columns = [pa.array([bucket], pa.int64()), pa.array([settled]), pa.array([found], pa.binary()), pa.array([h], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "settled", "docs", "h"])

        rows: list[tuple[int, np.ndarray]] = []
        held = 0
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text_words(body.as_py())
                if len(words) >= size:
                    rows.append((doc, word_hashes(words)))
                    held += len(words)
                if held >= chunk_words:
                    yield from packed(rows)
                    rows, held = [], 0
        yield from packed(rows)

    def meet(group: pa.Table) -> pa.Table:
        passing, meeting = [], []
        for settled, found, h in zip(group.column("settled").to_pylist(), group.column("docs"), group.column("h")):
            (passing if settled else meeting).append(_opened(found.as_py(), h.as_py()))
        if meeting:
            passing.append(_later(meeting))
        found, h = (np.concatenate(column) for column in zip(*passing))
        return pa.Table.from_arrays([pa.array(found), pa.array(h.view(np.int64))], ["doc", "h"])

    sent = thin.mapInArrow(run, "bucket long, settled boolean, docs binary, h binary")
    return sent.groupBy("bucket").applyInArrow(meet, "doc long, h long")


def remove_repeats(docs: DataFrame, size: int = SIZE, key: str = "doc_id", text: str = "text", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """(key, n_words, spans array<struct<start, end>>, kept): every document without the passages an earlier one has.

    A window is ``size`` consecutive words (runs of anything but space, tab, line feed, vertical tab, form feed and carriage return) of one
    document.  Every word covered by a window that also starts in a document with a smaller key goes; ``spans`` are the
    maximal intervals of such words, ``kept`` the other words joined by one space.  Windows are judged on the input.

    Null text has no words.  A null key is neither smaller nor larger than another: its text stays whole and takes no
    words from others.  Rows with one key do not remove each other's words, and what an earlier document has is removed from each of
    them; a repeat inside one document stays.  Texts shorter than a window, empty ones and an empty table lose
    nothing.  Other columns of ``docs`` are ignored, whatever their names.  Windows are told apart by a 64-bit hash:
    among 10^9 words the chance of any false match is about 3 %.
    """
    lists = repeated_windows(docs, size, key, text, chunk_words).groupBy("doc").agg(F.collect_list("h").alias("found"))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = pa.array([packer.compress(body.as_py()) for body in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["id", "text"])

    thin = docs.select(F.col(key).alias("id"), whole_text(text).cast("binary").alias("text"))
    thin = thin.mapInArrow(shrink, thin.schema)  # the exchange below takes the texts packed
    joined = thin.join(lists, F.col("id").cast("long") == F.col("doc"), "left").select("id", "text", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            counts, kept, cuts = [], [], []
            for body, found in zip(batch.column(1), batch.column(2)):
                words = text_words(opener.decompress(body.as_py()))
                counts.append(len(words))
                cut = np.empty((0, 2), np.int64)
                if found.is_valid:
                    cut = spans(np.isin(rabin_karp(word_hashes(words), size).view(np.int64), found.values.to_numpy()), size)
                    stay = np.ones(len(words), bool)
                    for start, end in cut:
                        stay[start:end] = False
                    words = [words[i] for i in np.flatnonzero(stay)]
                kept.append(b" ".join(words))
                cuts.append(cut)
            ends = pa.array(np.append(0, np.cumsum([len(cut) for cut in cuts])).astype(np.int32))
            pairs = np.concatenate([np.empty((0, 2), np.int64), *cuts]).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["start", "end"])
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(ends, pairs), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "spans", "kept"])

    kind = joined.schema["id"].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, n_words long, spans array<struct<start:int,end:int>>, kept string").withColumnRenamed("id", key)


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]))
    return cleaned.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents),
windows AS (SELECT n, doc_id, i, array_to_string(words[i : i + {SIZE - 1}], ' ') AS body
  FROM (SELECT n, doc_id, words, unnest(range(1, len(words) - {SIZE - 2})) AS i FROM d)),
firsts AS (SELECT body, min(doc_id) AS first FROM windows GROUP BY body),
covered AS (SELECT DISTINCT n, unnest(range(i, i + {SIZE})) AS i FROM windows JOIN firsts USING (body) WHERE doc_id > first),
gone AS (SELECT n, list(i) AS places FROM covered GROUP BY n),
kept AS (SELECT doc_id, words, coalesce(len(places), 0) AS removed,
    CASE WHEN places IS NULL THEN words ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END AS stay
  FROM d LEFT JOIN gone USING (n))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(removed AS BIGINT) AS n_removed,
  sha256(array_to_string(stay, ' ')) AS kept_sha256 FROM kept"""

QUERIES = {"op12_repeats": op12_repeats}
ORACLE = {"op12_repeats": SQL}
