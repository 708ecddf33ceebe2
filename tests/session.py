"""Local session shared by tests and checks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(cpus: str = "8") -> SparkSession:
    os.environ.setdefault("TZ", "UTC")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("geoledger-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
