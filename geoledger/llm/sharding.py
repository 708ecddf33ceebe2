"""Contiguous shards of equal bytes, cut on a global prefix sum of document sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoledger.llm.common import whole_text
from geoledger.sources.scratch import materialise

ROW_BYTES = 8
SHARDS = 24


def assign_shards(docs: DataFrame, n_shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot): documents in ascending key, cut where the running size passes k/n of the total.

    Only keys, sizes and checksums are ordered: a range exchange, one row of totals per range, and running sums inside each
    range.  A document goes to the shard that holds the middle of its bytes, so every shard is within one document of the
    target; a shard stays empty only where one document outweighs it.  ``size`` is the UTF-8 length plus 8, ``slot`` the
    gapless place inside the shard.

    Null text has size 8 and checksum 0.  Null keys come first.  Equal keys are ordered by checksum, size and input place
    (which also splits a key that holds most rows over several ranges), repeated rows are all kept, an empty table gives
    no rows, and other columns of ``docs`` are ignored whatever their names.
    """
    body = whole_text(text)
    thin = docs.select(
        F.col(key).alias("id"),
        (F.octet_length(body).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(body).alias("crc"),
    ).withColumn("place", F.monotonically_increasing_id())
    order = ["id", "crc", "size", "place"]
    placed = thin.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    stored = materialise(placed, "shard-ranges")

    totals = stored.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(
        totals.select(
            "part",
            F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("total"),
        ),
        "shard-offsets",
    )
    within = Window.partitionBy("part").orderBy(*order)
    running = stored.withColumn("end", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "row", F.row_number().over(within) - 1
    )
    middle = 2 * (F.col("bytes_before") + F.col("end")) - F.col("size")
    cut = materialise(
        running.join(offsets, "part").select(
            "id",
            "size",
            "crc",
            (F.col("rows_before") + F.col("row")).alias("row"),
            F.expr("2 * total").alias("whole"),
            (middle * n_shards).alias("scaled"),
        )
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr("int(scaled div whole)")))
        .select("id", "size", "crc", "row", "shard"),
        "shard-rows",
    )
    # one row per shard: its size is bounded by n_shards
    starts = F.broadcast(cut.groupBy("shard").agg(F.min("row").alias("start")))
    return cut.join(starts, "shard").select(
        F.col("id").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("row") - F.col("start")).alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` under ``path`` with one folder per shard and return the assignment; ``key`` must be unique."""
    assigned = materialise(assign_shards(docs, n_shards, key, text), "shards")
    kept = docs.drop("shard", "slot").join(assigned.select(key, "shard", "slot"), key)
    kept.write.partitionBy("shard").parquet(path)
    return assigned


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {"op9_shards": op9_shards}
ORACLE = {}
