"""The property roll-up as one job: city, then department, then region tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoledger.operators.statistics import city_stats, department_stats, region_stats
from geoledger.operators.upsert import upsert_replace


def property_rollup(
    areas: dict[str, DataFrame], tx: DataFrame, target: str, previous: str | None = None
) -> dict[str, DataFrame]:
    """Write the three statistics tables under ``target`` in dependency order and return them.

    Each level is read back from its table, so it is computed once and the next level starts from
    stored rows.  Without ``previous`` the tables hold this run alone (refresh); with the folder of an
    earlier run, areas this run has no statistics for keep their earlier row (upsert).  That folder
    cannot be ``target`` itself, whose tables are read while the new ones are written.
    """
    if previous is not None and previous.rstrip("/") == target.rstrip("/"):
        raise ValueError("the earlier run's folder cannot be overwritten while it is read")
    spark = tx.sparkSession
    stored: dict[str, DataFrame] = {}

    def store(level: str, stats: DataFrame) -> None:
        stats = stats.withColumn("extracted_at", F.current_timestamp())
        if previous is not None:
            stats = upsert_replace(stats, spark.read.parquet(f"{previous}/{level}"), [f"{level}_id"])
        stats.write.mode("overwrite").parquet(f"{target}/{level}")
        stored[level] = spark.read.parquet(f"{target}/{level}")

    store("city", city_stats(areas["city"], tx))
    store("department", department_stats(areas["department"], stored["city"]))
    store("region", region_stats(areas["region"], stored["department"]))
    return stored
