"""Exact grouped medians by rank bracketing, spread when one group holds most of the rows.

``percentile`` keeps every distinct value of a group in one aggregation buffer, so a city with a third of all sales would be one
task's hash map.  Here two passes read the input instead.  The first builds a mergeable quantile summary per group and
measure (``percentile_approx``, map-side) and takes its values just below and above the middle: a bracket that holds the middle
ranks, since a summary's ranks are wrong by at most one in ``ACCURACY``.  The second counts the values below the bracket and
keeps those inside, a few in ten thousand, and the running count of these finds the exact ranks.  Each pass exchanges
partial results only.  A bracket that missed its rank would fail the query; it never gives a wrong median.
NaN is the largest value, as in ``percentile``; infinities are ordinary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoledger.sources.scratch import materialise

ACCURACY = 10_000
MARGIN = 3 / ACCURACY


def _ordered(value: Column) -> Column:
    """The value as a summary takes it: NaN stands with the largest."""
    return F.when(F.isnan(value), F.lit(float("inf"))).otherwise(value)


def _bracketed(df: DataFrame, keys: list[str], aggregates: list[Column], values: dict[str, Column]) -> DataFrame:
    """One row per key, written: ``aggregates``, and per value how many there are and the bracket of their middle."""
    found = []
    for i, value in enumerate(values.values()):
        number = value.cast("double")
        ends = F.percentile_approx(_ordered(number), [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY)
        found += [F.count(number).alias(f"_n{i}"), ends.alias(f"_ends{i}")]
    return materialise(df.groupBy(*keys).agg(*aggregates, *found), "median-brackets")


def _medians(df: DataFrame, brackets: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """(keys, one column per value): the exact medians of the keys that have values."""
    numbers = df.select(*keys, *[value.cast("double").alias(f"_v{i}") for i, value in enumerate(values.values())])
    for key in keys:
        numbers = numbers.where(F.col(key).isNotNull())
    ends = [name for i in range(len(values)) for name in (f"_n{i}", f"_ends{i}")]
    joined = numbers.join(brackets.select(*keys, *ends), keys)
    spread = []
    for i in range(len(values)):
        number, low, high = F.col(f"_v{i}"), F.get(f"_ends{i}", F.lit(0)), F.get(f"_ends{i}", F.lit(1))
        place = _ordered(number)
        spread += [F.when((place >= low) & (place <= high), number).alias(f"_in{i}"), F.when(place < low, 1).alias(f"_below{i}")]
    totals = [f"_n{i}" for i in range(len(values))]
    inside = [f"_in{i}" for i in range(len(values))]
    # most rows are inside no bracket: they fold to one row per key before anything is unfolded or exchanged
    folded = joined.select(*keys, *totals, *spread).groupBy(*keys, *totals, *inside)
    folded = folded.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(f"_below{i}").alias(f"_below{i}") for i in range(len(values))])
    entries = []
    for i in range(len(values)):
        metric, total = F.lit(i).cast("tinyint").alias("_metric"), F.col(f"_n{i}").alias("_total")
        known = F.struct(metric, total, F.col(f"_in{i}").alias("_value"), F.col("_rows").alias("_n"))
        below = F.struct(metric, total, F.lit(None).cast("double").alias("_value"), F.col(f"_below{i}").alias("_n"))
        entries += [F.when(F.col(f"_in{i}").isNotNull(), known), F.when(F.col(f"_below{i}") > 0, below)]
    near = folded.select(*keys, F.explode(F.array_compact(F.array(*entries))).alias("_entry"))
    group = [*keys, "_metric"]
    counted = near.select(*keys, "_entry.*").groupBy(*group, "_total", "_value").agg(F.sum("_n").alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(*group).orderBy("_value").rowsBetween(W.unboundedPreceding, W.currentRow))
    lower, upper = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    inside = (F.col("_upto") >= lower) & (F.col("_upto") - F.col("_n") < upper)
    value = F.when(inside, F.col("_value"))
    reached = (F.max("_upto") >= F.max(upper)) & F.coalesce(F.max(F.when(F.col("_value").isNull(), F.col("_upto"))) < F.max(lower), F.lit(True))
    median = F.when(reached, F.min(value) * 0.5 + F.max(value) * 0.5).otherwise(
        F.raise_error(F.lit("a median lies outside its bracket")).cast("double")
    )
    medians = counted.withColumn("_upto", upto).groupBy(*group).agg(median.alias("_median"))
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_metric") == i, F.col("_median"))).alias(name) for i, name in enumerate(values)]
    )


def grouped_median(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """One row per key with the interpolated median of each value, nulls ignored.

    Rows with a null key are left out, and a key whose values are all null has no row: join the
    result with ``left``.
    """
    return _medians(df, _bracketed(df, keys, [], values), keys, values)


def aggregate_with_medians(df: DataFrame, keys: list[str], aggregates: list[Column], values: dict[str, Column]) -> DataFrame:
    """One row per key: ``aggregates`` plus the exact median of each value; the first pass serves both."""
    folded = _bracketed(df, keys, aggregates, values)
    known = folded.drop(*[name for i in range(len(values)) for name in (f"_n{i}", f"_ends{i}")])
    return known.join(_medians(df, folded, keys, values), keys, "left")
