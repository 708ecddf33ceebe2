"""Token counts through a digest cache: only distinct contents that were never counted are encoded."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm.common import ship_with_tasks, whole_text
from geoledger.sources.scratch import materialise, scratch_path

LIMIT = 512
#: Most chunk counts a task keeps.
KEPT_CHUNKS = 300_000
KEPT_LENGTH = 64
#: Texts encoded at once.
SLICE = 32

ship_with_tasks(__name__)


class JsonCounter:
    """Token counts of a ``tokenizers`` file, without added tokens.

    Byte-level vocabularies split a text before every single space, and around every single line break, that stands between
    two visible characters, whatever comes before and after; such parts are counted once per task.  Texts that
    have any other white space are split at the safe places only, other tokenizers count whole texts.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        pre = repr(self.library.pre_tokenizer)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        plain = pre.startswith("ByteLevel(") and "add_prefix_space=False" in pre and "use_regex=True" in pre
        flags = any(t.lstrip or t.rstrip or t.single_word for t in self.library.get_added_tokens_decoder().values())
        self.parts = plain and self.library.normalizer is None and not flags and not any(re.search(r"\s", t) for t in added)
        self.odd = re.compile(r"\s\s|^\s|\s$")
        self.safe = re.compile(r"(?<=\S) (?=\S)")
        self.spaced: dict[str, int] = {}
        self.bare: dict[str, int] = {}

    def _lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for at in range(0, len(texts), 1024) for e in self.library.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        if not self.parts:
            return self._lengths(texts)
        split: list[tuple[list[str], list[str], int]] = []
        for text in texts:
            if not text:
                split.append(([], [], 0))
            elif self.odd.search(text):
                first, *rest = self.safe.split(text)
                split.append(([first], rest, 0))
            else:
                lines = text.split("\n")
                bare, spaced = [], []
                for line in lines:
                    first, *rest = line.split(" ")
                    bare.append(first)
                    spaced.extend(rest)
                split.append((bare, spaced, len(lines) - 1))
        fresh_bare = self._fresh(self.bare, (p for bare, _, _ in split for p in bare), "")
        fresh_spaced = self._fresh(self.spaced, (p for _, spaced, _ in split for p in spaced), " ")
        line_break = self._lengths(["\n"])[0]
        out = []
        for bare, spaced, breaks in split:
            total = breaks * line_break
            for known, fresh, parts in ((self.bare, fresh_bare, bare), (self.spaced, fresh_spaced, spaced)):
                total += sum(known[p] if p in known else fresh[p] for p in parts)
            out.append(total)
        for known, fresh in ((self.bare, fresh_bare), (self.spaced, fresh_spaced)):
            if len(known) < KEPT_CHUNKS:
                known.update((p, n) for p, n in fresh.items() if len(p) <= KEPT_LENGTH)
        return out

    def _fresh(self, known: dict[str, int], parts: Iterator[str], lead: str) -> dict[str, int]:
        new = list({p for p in parts if p not in known})
        return dict(zip(new, self._lengths([lead + p for p in new])))


class PieceCounter:
    """Token counts of a sentencepiece model, without begin and end."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file: another file never reads this one's counts."""
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for this tokenizer; empty where nothing was stored yet."""
    schema = "version string, digest binary, n_tokens long"
    try:
        stored = spark.read.schema(schema).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], schema)
    return stored.where(F.col("version") == version).select("digest", "n_tokens")


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every whole text; new counts are appended to the parquet table ``cache``.

    The cache is keyed by the SHA-256 of the content and that of the tokenizer file.  Content is normalised only as far as
    no count can change: null is empty.  Texts are folded to one per digest with map-side aggregation (a third of all
    rows being one text is one row per task), those with a stored count go, the rest is encoded in Arrow batches and
    appended.  Counts then return to the documents by digest, a join of small rows that AQE splits where one digest holds
    most.  Runs that append the same digest twice store equal counts; readers fold them.

    Null and empty texts have 0 bytes and 0 tokens and are cached like any other.  Null keys and repeated rows are kept,
    an empty table gives no rows, other columns are ignored.  ``path`` is the same on driver and workers.
    """
    spark = docs.sparkSession
    version = tokenizer_version(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = JsonCounter(path) if path.endswith(".json") else PieceCounter(path)
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.slice(at, SLICE)
                counts = counter.count(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    body = whole_text(text)
    digest = F.unhex(F.sha2(body, 256))
    distinct = docs.select(digest.alias("digest"), body.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    misses = distinct.join(read_cache(spark, cache, version).select("digest").distinct(), "digest", "left_anti")
    counted = misses.mapInArrow(encode, "digest binary, n_tokens long")
    counted.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)

    # written, so that the join below is between two plain exchanges and AQE can split a hot digest
    known = materialise(read_cache(spark, cache, version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "known-counts")
    rows = docs.select(F.col(key).alias("id"), F.octet_length(body).cast("long").alias("n_bytes"), digest.alias("digest"))
    return rows.join(known, "digest").select(
        F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents by a cache that the delivery of one source, the last by name, has filled before."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "token-counts")
    latest = docs.agg(F.max("source").alias("source")).first()["source"]
    count_tokens(docs.where(F.col("source") == F.lit(latest)), path, cache)
    return count_tokens(docs, path, cache)


QUERIES = {"op7_token_counts": op7_token_counts}
ORACLE = {}
