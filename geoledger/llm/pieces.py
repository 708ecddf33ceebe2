"""SentencePiece encoding and decoding: merge-type vocabularies by a score-ordered agenda, checked against the library."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm.common import ship_with_tasks, worker_store

SPACE = "▁"
#: Most chunk encodings one worker process keeps.
KEPT_CHUNKS = 800_000
#: Longest chunk that is kept.
KEPT_LENGTH = 64

ship_with_tasks(__name__)


class Pieces:
    """Encoder over a merge-type vocabulary with byte fallback and no normalisation beyond the leading space mark.

    Symbols start as code points.  The agenda holds every adjacent pair that is itself a piece, best score first and the
    leftmost of equal scores; the best pair still standing merges and its new neighbours enter.  What is left and not in
    the vocabulary becomes its UTF-8 bytes.  No piece holds a space mark after another character, so a text splits before
    every run of space marks (and around characters that are in no longer piece) into chunks that encode on their own;
    the constructor verifies this of the vocabulary.
    """

    def __init__(self, path: str, store: dict | None = None) -> None:
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        plain = [i for i in range(size) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        self.ids = {library.id_to_piece(i): i for i in plain}
        self.scores = {library.id_to_piece(i): library.get_score(i) for i in plain}
        self.bytes = {int(library.id_to_piece(i)[1:-1], 16): i for i in range(size) if library.is_byte(i)}
        self.begin, self.end = library.bos_id(), library.eos_id()
        if len(self.bytes) != 256 or any(SPACE in p.lstrip(SPACE) for p in self.ids) or any("\n" in p for p in self.ids):
            raise ValueError("needs byte fallback and pieces with space marks in front only")
        if library.encode(" Ａ  b ", out_type=str)[0] != SPACE * 2 or "".join(library.encode("a  b", out_type=str)) != f"{SPACE}a{SPACE * 2}b":
            raise ValueError("needs a vocabulary without normalisation")
        self.chunks = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")
        #: Neighbours inside some piece; between any others nothing ever merges.
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.known = {} if store is None else store
        self.fresh: dict[str, bytes] = {}

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk by the agenda."""
        scores, symbols, n = self.scores, list(chunk), len(chunk)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                agenda.append((-scores[pair], i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != pair or after[left] != right:
                continue  # one of the two has merged elsewhere
            symbols[left], symbols[right] = pair, ""
            after[left] = follower = after[right]
            if follower < n:
                before[follower] = left
                if (new := pair + symbols[follower]) in scores:
                    heapq.heappush(agenda, (-scores[new], left, follower, new))
            leader = before[left]
            if leader >= 0 and (new := symbols[leader] + pair) in scores:
                heapq.heappush(agenda, (-scores[new], leader, left, new))
        ids = []
        for symbol in symbols:
            if symbol:
                found = self.ids.get(symbol)
                ids.extend([found] if found is not None else [self.bytes[b] for b in symbol.encode("utf-8")])
        return ids

    def _keep(self, chunk: str, packed: bytes) -> bytes:
        if len(self.known) < KEPT_CHUNKS and len(chunk) <= KEPT_LENGTH:
            self.known[chunk] = packed
        return packed

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk as little-endian unsigned 32-bit integers; kept while there is room."""
        joined, parts, start = self.joined, [], 0
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in joined:
                parts.append(chunk[start:i])
                start = i
        parts.append(chunk[start:])
        packed = b""
        for part in parts:
            found = self.known.get(part)
            if found is None:
                found = self._keep(part, np.array(self.merge(part), dtype="<u4").tobytes())
            packed += found
        self.fresh[chunk] = packed
        return self._keep(chunk, packed) if len(parts) > 1 else packed

    def encode(self, text: str) -> bytes:
        """Packed ids of the whole text, without begin and end."""
        if not text:
            return b""
        known = self.known
        found = self.chunks.findall(SPACE + text.replace(" ", SPACE))
        packed = [known.get(c) for c in found]
        if None in packed:
            packed = [p if p is not None else known.get(c) or self.chunk(c) for c, p in zip(found, packed)]
        return b"".join(packed)

    def check(self) -> None:
        """Encode the chunks that were new since the last check with the library too; a difference is an error."""
        fresh, self.fresh = self.fresh, {}
        # after a line break, which never merges, the library adds no space mark
        for (chunk, packed), ids in zip(fresh.items(), self.library.encode(["\n" + c for c in fresh], num_threads=1)):
            if np.array(ids[2:], dtype="<u4").tobytes() != packed:
                raise ValueError(f"the agenda and the library differ on {chunk[:80]!r}")

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def encoded(docs: DataFrame, model: str | None = None, key: str = "doc_id", text: str = "text", with_values: bool = True) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) and, with ``with_values``, (ids array<int>, decoded) of every whole text.

    Ids include begin and end.  Rows are independent, so there is no shuffle: Arrow batches go through ``Pieces`` in the task
    that scanned them.  Every chunk that the agenda encodes is encoded by the library as well before its batch is given
    back (a difference fails the job), and the decoded text is the library's.  A worker keeps a bounded number of chunks.

    Null text is empty: begin and end only.  Null keys, repeated rows and ties pass through, an empty table gives no rows,
    other columns are ignored.  ``model`` is a local path on the workers; by default the public 32k vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = model
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        with open(path, "rb") as file:
            version = hashlib.sha256(file.read()).hexdigest()
        coder = Pieces(path, worker_store("pieces_" + version))
        first, last = (np.array([i], dtype="<u4").tobytes() for i in (coder.begin, coder.end))
        for whole in batches:
            for at in range(0, len(whole), 64):
                batch = whole.slice(at, 64)
                counts, digests, decoded_digests, values, texts = [], [], [], [], []
                for value in batch.column(1):
                    packed = first + coder.encode(value.as_py() or "") + last
                    ids = np.frombuffer(packed, dtype="<u4").tolist()
                    decoded = coder.decode(ids)
                    counts.append(len(ids))
                    digests.append(hashlib.sha256(packed).hexdigest())
                    decoded_digests.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                    if with_values:
                        values.append(ids)
                        texts.append(decoded)
                coder.check()
                arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded_digests, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_values:
                    arrays += [pa.array(values, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_values
    thin = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return thin.mapInArrow(run, schema).withColumnRenamed("id", key)


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_values=False)


QUERIES = {"op6_pieces": op6_pieces}
ORACLE = {}
