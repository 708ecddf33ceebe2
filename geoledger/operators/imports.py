"""Import and roll-up jobs that end in stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger.functions.geometry import CORNERS, with_bbox
from geoledger.operators.reviews import department_documents, region_documents
from geoledger.operators.transactions import conform_transactions, drop_incomplete
from geoledger.operators.upsert import absent_rows, upsert_columns, upsert_replace
from geoledger.operators.validity import rebuild_crossing
from geoledger.sources.files import read_areas_geojson, read_transactions_csv, write_areas, write_transactions_by_place
from geoledger.sources.scratch import materialise, shuffles_removed

KEYS = ["tx_id", "parcel_id"]
ORDER = ["tx_date", "price", "city_id", "built_area", "land_area", "lon", "lat"]


def _apart(target: str, previous: str | None) -> None:
    if previous is not None and previous.rstrip("/") == target.rstrip("/"):
        raise ValueError("the earlier run's folder cannot be overwritten while it is read")


def import_transactions(spark: SparkSession, source: str, target: str, previous: str | None = None) -> DataFrame:
    """CSV files to the stored table of sales: complete rows, typed, first row per sale and parcel, in spatial order.

    Sales already stored under ``previous`` stay as they are; ``target`` then holds both.  Stored sales lie by place, so they are
    written as scanned and only new ones are dealt out: an import adds a run of files in order of place.  The shuffles of the job are
    deleted as it ends.
    """
    _apart(target, previous)
    with shuffles_removed(spark):
        new = conform_transactions(drop_incomplete(read_transactions_csv(spark, source)))
        stored = None if previous is None else spark.read.parquet(previous)
        write_transactions_by_place(absent_rows(new, stored, KEYS, ORDER), target, stored=stored)
    return spark.read.parquet(target)


def import_areas(
    spark: SparkSession, sources: dict[str, str], target: str, previous: str | None = None, partitions: int | None = None
) -> dict[str, DataFrame]:
    """Boundary files of each level to stored tables of repaired multipolygons with their boxes, in spatial order.

    Polygons whose rings cross are rebuilt and the area is marked in the stored column ``repaired``.  ``partitions`` spreads the
    features of a file before they are parsed; without it that many tasks as the cluster has cores.
    Of areas already stored under ``previous`` only geometry, box and mark are renewed.  Areas whose geometry cannot be read are
    not lost: they are stored without it under ``unreadable/<level>``, and their earlier outline stays.
    """
    _apart(target, previous)
    stored: dict[str, DataFrame] = {}
    for level, source in sources.items():
        key = f"{level}_id"
        read = read_areas_geojson(spark, source, level, partitions or spark.sparkContext.defaultParallelism)
        sound = rebuild_crossing(read.drop(*CORNERS)).withColumn("geometry", F.when(F.size("geometry") > 0, F.col("geometry")))
        areas = materialise(with_bbox(sound), f"{level}-areas")
        box = ["geometry", *CORNERS, "repaired"]
        areas.where(F.col("geometry").isNull()).drop(*box).write.mode("overwrite").parquet(f"{target}/unreadable/{level}")
        areas = areas.where(F.col("geometry").isNotNull())
        if previous is not None:
            areas = upsert_columns(areas, spark.read.parquet(f"{previous}/{level}"), [key], box)
        write_areas(areas, f"{target}/{level}")
        stored[level] = spark.read.parquet(f"{target}/{level}")
    return stored


def review_rollup(
    city_docs: DataFrame, cities: DataFrame, departments: DataFrame, regions: DataFrame, target: str, previous: str | None = None
) -> dict[str, DataFrame]:
    """Write department and region review documents under ``target`` with their extraction time and return them.

    Regions are built from the stored departments.  With the folder of an earlier run, areas that this run has no
    document for keep their earlier one.
    """
    _apart(target, previous)
    spark = city_docs.sparkSession
    stored: dict[str, DataFrame] = {}

    def store(level: str, docs: DataFrame) -> None:
        docs = docs.withColumn("extracted_at", F.current_timestamp())
        if previous is not None:
            docs = upsert_replace(docs, spark.read.parquet(f"{previous}/{level}"), [f"{level}_id"])
        docs.write.mode("overwrite").parquet(f"{target}/{level}")
        stored[level] = spark.read.parquet(f"{target}/{level}")

    store("department", department_documents(city_docs, cities, departments))
    store("region", region_documents(stored["department"], regions))
    return stored
