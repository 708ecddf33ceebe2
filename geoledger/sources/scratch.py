"""Intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path under ``spark.checkpoint.dir``, in a folder of this application.

    A local session without the setting gets a temporary folder; anywhere else its absence is an error, since
    executors would write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="geoledger-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/geoledger-{spark.conf.get('spark.app.id')}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote under ``spark.checkpoint.dir``; call it when no result is read any more."""
    remove_path(spark, scratch_path(spark, "").rpartition("/")[0])


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of scratch data that is not read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside are deleted as each of them ends, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends here and a lost executor recomputes nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
