from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from geoledger.functions.medians import aggregate_with_medians, grouped_median
from geoledger.functions.numbers import round_half_even, round_half_up, weighted_mean
from geoledger.operators import statistics as A
from geoledger.operators import upsert as U
from geoledger.operators.rollup import property_rollup
from geoledger.sources import bindings as B

SF = "/root/testdata/sf0.001"


def _same(actual, expected):
    order = sorted(expected.columns)
    key = lambda row: tuple(str(v) for v in row)
    assert sorted(map(tuple, actual.select(order).collect()), key=key) == sorted(
        map(tuple, expected.select(order).collect()), key=key
    )


def test_grouped_median_is_exact(rows):
    draw = random.Random(7)
    data = []
    for key, size in (("hot", 4001), ("even", 1000), ("one", 1), ("same", 500), ("signs", 301)):
        for i in range(size):
            value = {"same": 5.0, "signs": draw.choice([-1, 1, 0]) * draw.uniform(0, 3)}.get(key, draw.lognormvariate(8, 2))
            data.append((key, value, None if i % 3 == 0 else draw.uniform(0, 1e-3)))
    data += [("empty", None, 1.0), (None, 3.0, 3.0)]
    found = grouped_median(rows(data, "k string, a double, b double"), ["k"], {"a": F.col("a"), "b": F.col("b")})
    actual = {r["k"]: (r["a"], r["b"]) for r in found.collect()}
    for key in {k for k, _, _ in data if k}:
        for i, name in ((1, "a"), (2, "b")):
            known = [row[i] for row in data if row[0] == key and row[i] is not None]
            expected = statistics.median(known) if known else None
            assert actual[key][i - 1] == expected, (key, name)


def test_a_hot_group_keeps_its_exact_median(spark):
    """300 000 rows, two thirds in one group, in orders and with ties that summaries have to merge."""
    n = F.col("id")
    mixed = F.pmod(F.xxhash64("id"), F.lit(10**6)).cast("double")
    df = spark.range(0, 300_000, numPartitions=12).select(
        F.when(n % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), n % 50)).alias("k"),
        mixed.alias("mixed"),
        n.cast("double").alias("rising"),
        (mixed % 7).alias("ties"),
        F.when(n % 5 < 2, float("nan")).when(n % 11 == 0, float("-inf")).otherwise(-mixed).alias("odd"),
        F.when(n % 4 == 0, mixed / 3).alias("sparse"),
    )
    names = ["mixed", "rising", "ties", "odd", "sparse"]
    found = grouped_median(df, ["k"], {name: F.col(name) for name in names})
    plain = df.groupBy("k").agg(*[F.percentile(name, 0.5).alias(name) for name in names])
    read = lambda rows: {r["k"]: tuple(str(r[name]) for name in names) for r in rows.select("k", *names).collect()}
    assert read(found) == read(plain)


def test_a_bracket_that_misses_fails(spark, monkeypatch):
    from geoledger.functions import medians

    df = spark.range(0, 1000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("v"))
    monkeypatch.setattr(medians, "MARGIN", -0.1)  # both ends on the wrong side of the middle
    with pytest.raises(Exception, match="outside its bracket"):
        grouped_median(df, ["k"], {"m": F.col("v")}).collect()


def test_medians_equal_percentile(rows):
    nan, inf = float("nan"), float("inf")
    groups = {
        "nan": [1.0, 2.0, 3.0, nan], "nans": [5.0, 6.0, 7.0, nan, nan], "inf": [1.0, 2.0, inf], "both": [-inf, inf, 4.0, 4.0],
        "all": [nan, nan], "ends": [-inf, -inf, inf], "signs": [-3.0, -1.0, 0.0, 2.0], "zero": [0.0, 0.0], "one": [7.5], "big": [1.7e308, 1.7e308],
    }
    df = rows([(k, v) for k, values in groups.items() for v in values], "k string, v double")
    for some in (df, df.where("k = 'one'"), df.where("k = 'none'")):
        plain = {r["k"]: str(r["m"]) for r in some.groupBy("k").agg(F.percentile("v", 0.5).alias("m")).collect()}
        assert {r["k"]: str(r["m"]) for r in grouped_median(some, ["k"], {"m": F.col("v")}).collect()} == plain


def test_median_of_medians_and_null_groups(rows):
    df = rows([("a", 1.0), ("a", 2.0), ("a", None), ("a", 4.0), ("a", 10.0), ("b", None)], "k string, v double")
    found = aggregate_with_medians(df, ["k"], [F.count("v").alias("n")], {"m": F.col("v")})
    assert {r["k"]: r["m"] for r in found.collect()} == {"a": 3.0, "b": None}


def test_weighted_mean(rows):
    df = rows([(10.0, 1), (20.0, 3)], "m double, n bigint")
    assert df.agg(weighted_mean("m", "n")).first()[0] == 17.5


def test_weighted_mean_counts_weight_of_missing_means(rows):
    df = rows([(10.0, 1), (None, 1), (5.0, 0)], "m double, n bigint")
    assert df.agg(weighted_mean("m", "n")).first()[0] == 5.0
    assert rows([(5.0, 0)], "m double, n bigint").agg(weighted_mean("m", "n")).first()[0] is None


def test_rounding(rows):
    df = rows([(0.125, 2.5), (-0.125, 3.5)], "a double, b double")
    found = df.select(round_half_up(F.col("a"), 2), round_half_even(F.col("b"), 0)).collect()
    assert [tuple(r) for r in found] == [(0.13, 2.0), (-0.13, 4.0)]


def test_cities_without_sales_do_not_appear(spark, rows):
    cities = B.cities(spark, SF)
    tx = rows(
        [("1", "1", None, 0.0, "0", 10.0, None, 1.0, 1.0), ("2", "1", None, 100.0, "1", 0.0, 5.0, 1.0, 1.0)],
        "tx_id string, parcel_id string, tx_date date, price double, city_id string, built_area double, "
        "land_area double, lon double, lat double",
    )
    found = A.city_stats(cities, tx).collect()
    assert [(r["city_id"], r["transactions"], r["transactions_built"], r["price_m2_mean"]) for r in found] == [("1", 1, 0, None)]


def test_rollup_upsert_keeps_missing_areas_and_is_idempotent(spark, tmp_path):
    areas = {"city": B.cities(spark, SF), "department": B.departments(spark, SF), "region": B.regions(spark, SF)}
    tx = B.transactions(spark, SF)
    paths = [str(tmp_path / name) for name in ("a", "b", "c")]
    first = property_rollup(areas, tx, paths[0])
    again = property_rollup(areas, tx, paths[1], previous=paths[0])
    part = property_rollup(areas, tx.where(F.col("city_id") == "3"), paths[2], previous=paths[0])
    for level in ("city", "department", "region"):
        _same(again[level].drop("extracted_at"), first[level].drop("extracted_at"))
    _same(part["city"].drop("extracted_at"), first["city"].drop("extracted_at"))


def test_dedup_insert(rows):
    schema = "tx string, parcel string, price double"
    new = rows([("1", "a", 2.0), ("1", "a", 2.0), ("1", "a", 1.0), ("2", "b", 5.0)], schema)
    old = rows([("2", "b", 9.0)], schema)
    once = U.dedup_insert(new, old, ["tx", "parcel"], ["price"])
    expected = [("1", "a", 1.0), ("2", "b", 9.0)]
    assert sorted(map(tuple, once.collect())) == expected
    twice = U.dedup_insert(new, once, ["tx", "parcel"], ["price"])
    assert sorted(map(tuple, twice.collect())) == expected


def test_upserts(rows):
    old = rows([("1", "x", 1.0), ("2", "y", 2.0)], "id string, name string, g double")
    new = rows([("2", "z", 7.0), ("3", "w", 8.0)], "id string, name string, g double")
    geometry = sorted(map(tuple, U.upsert_columns(new, old, ["id"], ["g"]).collect()))
    assert geometry == [("1", "x", 1.0), ("2", "y", 7.0), ("3", "w", 8.0)]
    replaced = U.upsert_replace(new, old, ["id"])
    assert sorted(map(tuple, replaced.collect())) == [("1", "x", 1.0), ("2", "z", 7.0), ("3", "w", 8.0)]
    assert sorted(map(tuple, U.upsert_replace(new, replaced, ["id"]).collect())) == sorted(map(tuple, replaced.collect()))
    merged = U.upsert_merge(new.select("id", "name"), old, ["id"])
    assert sorted(map(tuple, merged.collect())) == [("1", "x", 1.0), ("2", "z", 2.0), ("3", "w", None)]


def test_upsert_columns_can_set_null(rows):
    old = rows([("1", 1.0)], "id string, g double")
    new = rows([("1", None)], "id string, g double")
    assert U.upsert_columns(new, old, ["id"], ["g"]).collect()[0]["g"] is None


def test_rollup_over_its_own_folder_is_refused(spark, tmp_path):
    areas = {"city": B.cities(spark, SF), "department": B.departments(spark, SF), "region": B.regions(spark, SF)}
    folder = str(tmp_path / "stats")
    property_rollup(areas, B.transactions(spark, SF), folder)
    before = sorted(map(tuple, spark.read.parquet(f"{folder}/city").collect()), key=str)
    with pytest.raises(ValueError, match="cannot be overwritten"):
        property_rollup(areas, B.transactions(spark, SF), folder, previous=folder + "/")
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/city").collect()), key=str) == before
