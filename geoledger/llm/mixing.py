"""Mixing sources to target weights: Poisson replication, then a global shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.llm.common import whole_text
from geoledger.sources.scratch import materialise

#: A rate is split into equal parts of at most this mean, each inverted on its own; their sum has the whole rate.
PART_MEAN = 8
#: Terms of the distribution function; P(X > 64) is under 2^-52 for a mean of 8.
TERMS = 64


def _size(text: str) -> Column:
    return F.octet_length(whole_text(text)).cast("long") + 1


def tempered_weights(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """(source, weight): the square root of each source's bytes, which lifts small sources."""
    sizes = docs.select(F.col(source).alias("source"), _size(text).alias("size"))
    return sizes.groupBy("source").agg(F.sqrt(F.sum("size").cast("double")).alias("weight"))


def uniform(*parts: Column) -> Column:
    """52 bits of the MD5 of the joined parts as a number in [0, 1)."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def repetition_rates(docs: DataFrame, weights: DataFrame, total_bytes: int | None, source: str, text: str) -> DataFrame:
    """(source, parts, cdf): how often a document of the source is wanted, as a distribution function per part."""
    sizes = docs.select(F.col(source).alias("source"), _size(text).alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    wanted = weights.select(F.col("source").alias("wanted"), F.col("weight").cast("double").alias("weight"))
    known = sizes.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").select(
        "source", "size", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
    )
    known = materialise(known, "source-sizes")
    # one row: the sums over the sources
    sums = known.agg(F.sum("weight").alias("w"), F.sum("size").alias("b")).first()
    total = float(total_bytes if total_bytes is not None else (sums["b"] or 0))
    rate = F.col("weight") / F.lit(sums["w"] or 1.0) * F.lit(total) / F.col("size")
    rated = known.withColumn("rate", rate).withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int"))
    cdf = F.expr(
        f"""transform(array(rate / parts), m -> aggregate(sequence(1, {TERMS}),
            named_struct('p', exp(-m), 'c', array(exp(-m))),
            (a, k) -> named_struct('p', a.p * m / k, 'c', concat(a.c, array(element_at(a.c, -1) + a.p * m / k))),
            a -> a.c))[0]"""
    )
    return rated.select("source", "parts", cdf.alias("cdf"))


def mix_sources(
    docs: DataFrame,
    weights: DataFrame,
    total_bytes: int | None = None,
    seed: int = 0,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """All columns of ``docs`` plus ``copy`` (from 0), ``n_copies`` and ``mix_key``, in globally shuffled order.

    A source of weight w wants w / sum(w) of ``total_bytes`` (all bytes at hand by default); its rate is that over its own
    bytes.  A document is repeated by the Poisson quantile, at its rate, of a uniform number hashed from seed and key: a
    recomputed task draws the same count, and no state is shared.  Copies then travel to a place hashed from seed, key and
    copy number, so a source with a third of all rows is spread evenly; the join with the rates is on a table with one row
    per source, which Spark broadcasts only below its own size limit and otherwise splits by AQE.

    Sources without a weight (or with one below zero) have rate 0 and give no rows; a null source is a source like any
    other.  Null text counts one byte.  Equal keys draw equal counts, and repeated rows are each repeated.  An empty table
    gives no rows.  Columns of ``docs`` named ``copy``, ``n_copies`` or ``mix_key`` are replaced; others may
    have any names.
    """
    rates = materialise(repetition_rates(docs, weights, total_bytes, source, text), "source-rates")
    own = [c for c in docs.columns if c not in ("copy", "n_copies", "mix_key")]
    lead = "_" * (1 + max(len(c) for c in docs.columns))  # longer than any name there is
    wanted, parts, cdf = (lead + name for name in ("source", "parts", "cdf"))
    rates = rates.toDF(wanted, parts, cdf)
    joined = docs.select(*own).join(rates, docs[source].eqNullSafe(rates[wanted]))
    id_text = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    draws = F.transform(
        F.sequence(F.lit(1), F.col(parts)),
        lambda j: F.size(F.filter(F.col(cdf), lambda c: c <= uniform(F.lit(seed), id_text, j))),
    )
    counted = joined.withColumn("n_copies", F.aggregate(draws, F.lit(0), lambda a, x: a + x)).where("n_copies > 0")
    copies = counted.select(*own, "n_copies", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"))
    keyed = copies.withColumn("mix_key", F.md5(F.concat_ws("|", F.lit("order"), F.lit(seed), id_text, F.col("copy"))))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mix_sources(docs, tempered_weights(docs))
    return mixed.select("doc_id", "source", "lang", "text", "n_chars", "copy", "n_copies", "mix_key")


QUERIES = {"op3_mix": op3_mix}
ORACLE = {
    "op3_mix": f"""
WITH sizes AS (SELECT source, sum(strlen(coalesce(text, '')) + 1)::DOUBLE AS size FROM documents GROUP BY source),
weights AS (SELECT source, size, sqrt(size) AS weight FROM sizes),
rates AS (
  SELECT source, weight / (SELECT sum(weight) FROM weights) * (SELECT sum(size) FROM sizes) / size AS rate FROM weights),
parts AS (SELECT source, rate, greatest(ceil(rate / {PART_MEAN}), 1)::INT AS parts FROM rates),
terms AS (
  SELECT source, parts, k, CASE WHEN k = 0 THEN exp(-rate / parts)
    ELSE exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)) END AS p
  FROM parts, range(0, {TERMS + 1}) AS t(k)),
cdf AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
draws AS (
  SELECT d.doc_id, d.source, j,
    ('0x' || substr(md5('0|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, range(1, 1000) AS t(j) WHERE j <= p.parts),
counts AS (
  SELECT doc_id, sum(n)::INT AS n_copies FROM (
    SELECT d.doc_id, d.j, count(*) FILTER (c.c <= d.u) AS n
    FROM draws d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source GROUP BY d.doc_id, d.j) GROUP BY doc_id),
copies AS (
  SELECT d.*, c.n_copies, unnest(range(0, c.n_copies))::INT AS copy FROM documents d JOIN counts c ON d.doc_id = c.doc_id)
SELECT doc_id, source, lang, text, n_chars, copy, n_copies,
  md5('order|0|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy) AS mix_key FROM copies
"""
}
