"""Connected components of a link table, every step a join or an aggregate on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.sources.scratch import materialise


def _smallest(links: DataFrame) -> DataFrame:
    """(a, m): the smaller of ``a`` and its smallest partner; written, so that the join with it can be split by AQE."""
    return materialise(links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "smallest")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(2**31)))).first())


def component_labels(links: DataFrame) -> DataFrame:
    """(id, component_id) for every id in ``links`` (a, b): the smallest id it can reach.

    Alternating large-star and small-star steps: each id hands its larger partners, then all its partners, to the smallest id
    it knows, until every id points at its component's smallest.  The number of steps grows with the logarithm of the
    size, the number of links never grows, and every step is written to the shared folder, so lost executors repeat one step.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialise(ordered, "links")
    state = _state(current)
    while state[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_smallest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "large-star")
        small = large.join(_smallest(large), "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("l"))
        small = small.select(F.col("l.a").alias("a"), F.col("l.m").alias("b")).where("a <> b").distinct()
        current = materialise(small, "small-star")
        previous, state = state, _state(current)
        if state == previous:
            break
    members = current.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    return members.unionByName(current.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
