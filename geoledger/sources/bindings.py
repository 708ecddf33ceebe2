"""The territorial model read from the star-schema test tables.

region -> regions, nation -> departments, supplier -> cities, lineitem -> transactions,
documents -> reviews, pages -> review pages, events -> incremental reviews.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions import geometry as G
from geoledger.schemas import LEXICON
from geoledger.sources.lexicon import ROWS

SIDE = 0.9  # side of a city square in degrees
SQUARE = G.square("x0", "y0", SIDE)

# Columns the bindings read; other columns of a table are never scanned.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "customer": "c_custkey bigint",
    "orders": "o_orderkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores when a table is stored in fewer pieces than that; larger tables stay as scanned."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").selectExpr("string(r_regionkey) AS region_id", "r_name AS name")


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "string(n_nationkey) AS department_id", "n_name AS name", "string(n_regionkey) AS region_id"
    )


def _corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey AS s_nationkey", "n_regionkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey")
        .selectExpr(
            "string(s_suppkey) AS city_id",
            "s_name AS name",
            "string(s_nationkey) AS department_id",
            "string(n_regionkey) AS region_id",
            "double(-5 + s_suppkey % 14) AS x0",
            "double(42 + (s_suppkey div 14) % 9) AS y0",
        )
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities with their square and its bounding box."""
    return _corners(spark, sf_dir).selectExpr(
        "city_id",
        "name",
        "department_id",
        "region_id",
        f"array({SQUARE}) AS geometry",
        "x0 AS min_x",
        "y0 AS min_y",
        f"x0 + {SIDE}D AS max_x",
        f"y0 + {SIDE}D AS max_y",
    )


def _outlines(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Parent areas as multipolygons; at most 14 x 9 different squares per parent."""
    squares = _corners(spark, sf_dir).select(key, "x0", "y0").distinct()
    return G.with_bbox(squares.groupBy(key).agg(F.expr(f"array_sort(collect_set({SQUARE})) AS geometry")))


def department_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return departments(spark, sf_dir).join(_outlines(spark, sf_dir, "department_id"), "department_id")


def region_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regions(spark, sf_dir).join(_outlines(spark, sf_dir, "region_id"), "region_id")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "string(l_orderkey) AS tx_id",
        "string(l_linenumber) AS parcel_id",
        "date(l_shipdate) AS tx_date",
        "CASE WHEN l_orderkey % 41 = 0 THEN 0D WHEN l_orderkey % 43 = 0 THEN l_discount * 1000"
        " ELSE l_extendedprice END AS price",
        "string(l_suppkey) AS city_id",
        "CASE WHEN l_discount = 0 THEN 0D WHEN l_suppkey % 9 = 0 THEN l_quantity * 100 ELSE l_quantity END AS built_area",
        "CASE WHEN l_tax > 0 THEN l_quantity * 10 END AS land_area",
        "CASE WHEN l_orderkey % 47 <> 0 THEN -5 + double(l_partkey % 1400) / 100 END AS lon",
        "42 + double(l_orderkey % 900) / 100 AS lat",
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    def score(shift: int) -> str:
        return f"double((n_chars + {shift}) % 9 + 2) / 2"

    return spread(table(spark, sf_dir, "documents"), "doc_id").selectExpr(
        "string(doc_id) AS review_id",
        "CASE WHEN doc_id % 97 = 0 THEN 'unknown' ELSE string(doc_id % 80) END AS city_id",
        f"CASE WHEN doc_id % 53 <> 0 THEN {score(0)} END AS score",
        *[f"{score(i)} AS {name}" for i, name in enumerate(C.CATEGORIES, start=1)],
        "text AS description",
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = (
        "CASE s_suppkey % 4 WHEN 0 THEN concat('town-', s_suppkey)"
        " WHEN 1 THEN concat('town-', s_suppkey, '/quartier-', s_suppkey)"
        " WHEN 2 THEN concat('arrondissement/', s_suppkey) ELSE 'about' END"
    )
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", f"concat('https://reviews.example/', {path}, '/avis.html') AS url"
    )


def city_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities as stored by the crawler: scores, review count, address and processing state."""
    measures = ["count(review_id) AS n", "avg(coalesce(score, 0D)) AS mean", *[f"avg({c}) AS {c}" for c in C.CATEGORIES]]
    known = reviews(spark, sf_dir).groupBy("city_id").agg(*[F.expr(text) for text in measures])
    address = urls(spark, sf_dir).selectExpr("string(id) AS city_id", "url")

    def stored(name: str) -> str:
        value = f"coalesce(double(round(try_cast({name} AS decimal(30,6)), 1)), 0D)"
        shift = " + if(number % 10 = 0 AND n IS NOT NULL, 1D, 0D)" if name == "mean" else ""
        return f"'{name}', {value}{shift}"

    return (
        _corners(spark, sf_dir)
        .selectExpr("city_id", "name", "department_id", "bigint(city_id) AS number")
        .join(known, "city_id", "left")
        .join(address, "city_id")
        .selectExpr(
            "city_id",
            "name",
            "lpad(city_id, 5, '0') AS postal_code",
            "city_id AS insee_code",
            "department_id",
            "url",
            f"named_struct({', '.join(stored(name) for name in C.SCORES)}) AS scores",
            "coalesce(n, 0L) AS review_count",
            "CASE number % 3 WHEN 0 THEN 'processed' WHEN 1 THEN 'unprocessed' END AS status",
            "CASE WHEN number % 3 = 0 THEN TIMESTAMP'2024-01-01 00:00:00' + make_dt_interval(int(number % 60)) END AS processed_at",
        )
    )


def lexicon(spark: SparkSession) -> DataFrame:
    """Small French lexicon (token, lemma, pos, is_stop) shipped for examples and checks; local rows, so that Spark knows its size."""
    names = [field.split()[0] for field in LEXICON.split(", ")]
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*ROWS))))), LEXICON)


def event_reviews(events: DataFrame) -> DataFrame:
    """Events read as reviews, for batch and streaming frames alike."""
    return events.selectExpr(
        "string(event_id) AS review_id",
        "string(user_id % 80) AS city_id",
        "1 + double(floor(value) % 9) / 2 AS score",
        "concat(event_type, CASE event_id % 3 WHEN 0 THEN ' et le parc' WHEN 1 THEN ' et la mairie du parc' ELSE '' END) AS description",
        "date(ts) AS review_day",
    )
