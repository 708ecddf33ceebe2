"""A corpus run: quality, near copies, mixture of sources, pieces.  Every stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm.mixing import mix_sources, tempered_weights
from geoledger.llm.pieces import encoded
from geoledger.llm.quality import quality_scores, train
from geoledger.llm.simhash import keep_one_of_each
from geoledger.sources.scratch import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(docs, model).where("predicted = 1").select(*COLUMNS)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    return keep_one_of_each(docs).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated towards tempered weights and shuffled; a document drawn twice is there twice."""
    return mix_sources(docs, tempered_weights(docs)).select(*COLUMNS)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of the mixture."""
    return encoded(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality classifier", quality_stage),
    ("SimHash near-dedup", near_copy_stage),
    ("mixing sources to target weights", mixing_stage),
    ("SentencePiece encoding and decoding", pieces_stage),
]

#: The classifier's compressed sizes and the vocabulary's merges have no SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
