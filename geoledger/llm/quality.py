"""Quality classifier by compression: dictionaries of good and bad text, and the calibrated difference of compressed sizes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from geoledger.llm.common import ship_with_tasks
from geoledger.sources.scratch import materialise

#: Bounds of the training sample: labelled texts per class for its dictionary, texts for the calibration, and bytes of each of
#: these three parts.  Texts are whole and of any length; a part ends with the text that reaches its bytes.
DICTIONARY_TEXTS = 1500
CALIBRATION_TEXTS = 4000
SAMPLE_BYTES = 32 << 20
DICTIONARY_BYTES = 65_536
LEVEL = 3
#: Largest normalised difference that counts; very short texts go beyond by chance.
CLIP = 0.3
THRESHOLD = 0.3

ship_with_tasks(__name__)


def held_out(key: str = "doc_id") -> Column:
    """One row in five is never learned from."""
    return F.crc32(F.col(key).cast("string")) % 5 == 0


def dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary of the samples; their plain content where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Differ:
    """(size with the bad dictionary - size with the good one) / bytes of the text."""

    def __init__(self, good: bytes, bad: bytes, level: int = LEVEL) -> None:
        import zstandard

        self.pair = []
        for content in (good, bad):
            if len(content) < 8:
                self.pair.append(zstandard.ZstdCompressor(level=level))
                continue
            data = zstandard.ZstdCompressionDict(content)
            data.precompute_compress(level=level)
            self.pair.append(zstandard.ZstdCompressor(level=level, dict_data=data))

    def difference(self, text: str | None) -> float:
        raw = (text or "").encode("utf-8", "surrogatepass")
        good, bad = (len(c.compress(raw)) for c in self.pair)
        return max(-CLIP, min(CLIP, (bad - good) / max(len(raw), 1)))


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    #: Rising curve from difference to share of good text, as its knots.
    differences: tuple[float, ...]
    shares: tuple[float, ...]

    def score(self, difference: float) -> float:
        return float(np.interp(difference, self.differences, self.shares))


def calibrate(differences: np.ndarray, labels: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Knots of the rising curve that fits the labels best: neighbours out of order are pooled (isotonic regression).

    Each pool's share is smoothed by half a text of either class, and the curve rises between the pools' middles, and a
    little inside them, so that differences keep their order.
    """
    pools: list[list[float]] = []
    order = np.lexsort((labels, differences))
    for at in order:
        pools.append([labels[at], 1.0, differences[at], differences[at]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            good, n, _, high = pools.pop()
            pools[-1] = [pools[-1][0] + good, pools[-1][1] + n, pools[-1][2], high]
    xs, ys = [-CLIP], [0.0]
    for good, n, low, high in pools:
        share = (good + 0.5) / (n + 1)
        for x, y in ((low, share - 0.005), (high, share + 0.005)):
            if x > xs[-1]:
                xs.append(float(x))
                ys.append(float(min(max(y, ys[-1]), 1.0)))
    if len(pools) <= 1:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return (-CLIP, CLIP), (float(share), float(share))
    if xs[-1] < CLIP:
        xs.append(CLIP)
        ys.append(1.0)
    return tuple(xs), tuple(ys)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 0) -> Model:
    """Fit on labelled rows that are not held out, a sample bounded by the constants above whatever the size of the tables.

    Rows are drawn by a hash of their id, whatever their length, so the sample is the same on every run; the rows of the
    calibration are others than those of the dictionaries.  Label rows with null id or a quality other than 0 and 1 are void; an id
    labelled both ways is taken at its larger label, an id with several texts at the least of them.  Without usable labels every score
    is one half.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    usable = usable.groupBy(F.col(key).alias("_id")).agg(F.max("quality").alias("_quality"))
    drawn = F.md5(F.concat_ws("|", F.lit(seed), F.col("_id")))
    texts = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    candidates = usable.join(texts.select("_id"), "_id", "left_semi").withColumn("_draw", drawn)
    # three limits with fixed bounds, so the ids can be sent to every task; every second id is for the calibration
    tuned = F.crc32("_draw") % 2 == 1
    good, bad = (candidates.where(~tuned & (F.col("_quality") == q)).orderBy("_draw").limit(DICTIONARY_TEXTS) for q in (1, 0))
    parts = [good, bad, candidates.where(tuned).orderBy("_draw").limit(CALIBRATION_TEXTS)]
    parts = [part.select("_id", "_quality", "_draw", F.lit(use).alias("_part")) for use, part in zip("gbc", parts)]
    ids = parts[0].unionByName(parts[1]).unionByName(parts[2])
    one = texts.join(F.broadcast(ids), "_id").groupBy("_id", "_quality", "_draw", "_part").agg(F.min("_text").alias("_text"))
    stored = materialise(one, "quality-sample")
    before = Window.partitionBy("_part").orderBy("_draw", "_id").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.select("_id", "_part", "_draw", F.coalesce(F.sum(F.octet_length("_text")).over(before), F.lit(0)).alias("_before"))
    taken = sizes.where(F.col("_before") < SAMPLE_BYTES).select("_id")  # at most as many rows as ``ids``
    rows = stored.join(F.broadcast(taken), "_id", "left_semi").collect()
    rows.sort(key=lambda r: r["_id"])
    samples = {q: [r["_text"].encode() for r in rows if r["_part"] == part] for q, part in ((1, "g"), (0, "b"))}
    good_dict, bad_dict = dictionary(samples[1]), dictionary(samples[0])
    differ = Differ(good_dict, bad_dict)
    others = [r for r in rows if r["_part"] == "c"]
    differences = np.array([differ.difference(r["_text"]) for r in others], dtype=float)
    knots = calibrate(differences, np.array([r["_quality"] for r in others], dtype=float))
    return Model(good_dict, bad_dict, *knots)


def quality_scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``score`` (0 to 1, higher is better) and ``predicted`` (1 from the threshold up).

    Each whole text is compressed with both dictionaries in the task that scanned it; nothing else of a row enters the
    score.  Null and empty texts have difference 0 and the score of that.  Repeated rows are kept and score alike, an empty
    table gives no rows, and columns of ``docs`` named ``score`` or ``predicted`` are replaced.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        differ = Differ(model.good, model.bad)
        for batch in batches:
            scores = [model.score(differ.difference(value.as_py())) for value in batch.column(at)]
            predicted = pa.array([int(s >= threshold) for s in scores], pa.int32())
            names = [*batch.schema.names, "score", "predicted"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), predicted], names)

    own = docs.drop("score", "predicted").withColumn(text, F.col(text).cast("string"))
    at = own.columns.index(text)
    return own.mapInArrow(run, StructType([*own.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())]))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_scores(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op10_quality": op10_quality}
ORACLE = {}
