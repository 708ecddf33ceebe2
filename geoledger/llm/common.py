"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoledger.sources.scratch import materialise


def ship_with_tasks(module: str) -> None:
    """Send the functions of ``module`` to the workers by value, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship_with_tasks(__name__)


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker process; callers bound its size."""
    return sys.modules.setdefault(f"_store_{name}", ModuleType(name)).__dict__


def whole_text(text: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def successors(keys: DataFrame) -> DataFrame:
    """(key, next_key) of the distinct non-null values of the only column, in ascending order, the last followed by the first.

    Ranges are ordered by one row per partition; no task sees all keys.
    """
    name = keys.columns[0]
    ranges = keys.where(F.col(name).isNotNull()).distinct().toDF("key").repartitionByRange("key")
    stored = materialise(ranges.withColumn("part", F.spark_partition_id()), "ranges")
    by_part = Window.orderBy("part")
    everything = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = stored.groupBy("part").agg(F.min("key").alias("first"))
    heads = firsts.select("part", F.coalesce(F.lead("first").over(by_part), F.min("first").over(everything)).alias("head"))
    inner = stored.withColumn("next_key", F.lead("key").over(Window.partitionBy("part").orderBy("key")))
    return inner.join(materialise(heads, "range-heads"), "part").select("key", F.coalesce("next_key", "head").alias("next_key"))
