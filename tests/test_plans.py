"""Plans of the heavy operators: pushdown, pruning, partial top-k, shared shuffles."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from geoledger.functions.medians import grouped_median
from geoledger.operators import transactions as P
from geoledger.operators import upsert as U
from geoledger.operators import words as T
from geoledger.operators.areas import intersecting
from geoledger.plans import inputs as I
from geoledger.sources import bindings as B
from geoledger.sources.scratch import materialise

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def _tree(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_viewport_filters_reach_the_scan(spark):
    areas = materialise(B.cities(spark, SF), "areas")
    plan = _plan(intersecting(areas, I.CITY_VIEW))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    for name in ("min_x", "max_x", "min_y", "max_y"):
        assert f"({name}," in pushed
    sales = materialise(B.transactions(spark, SF), "sales")
    plan = _plan(P.recent_transactions(sales, I.CITY_VIEW))
    assert "TakeOrderedAndProject" in plan and "GreaterThan(lon,1.0)" in plan and "GreaterThanOrEqual(price,500.0)" in plan


def test_columns_are_pruned(spark):
    sales = materialise(B.transactions(spark, SF), "sales")
    plan = _plan(P.visible_transactions(sales).groupBy("city_id").agg(F.sum("price").alias("s")))
    assert "ReadSchema: struct<price:double,city_id:string>" in plan


def test_top_k_is_cut_before_the_shuffle(spark):
    counts = materialise(T.city_word_counts(B.reviews(spark, SF), B.lexicon(spark)), "counts")
    plan = _tree(T.top_words(counts.repartition(4), ["city_id"], 150))
    assert plan.count("WindowGroupLimit") == 2
    sales = materialise(B.transactions(spark, SF), "sales")
    plan = _tree(U.first_per_key(sales.repartition(4), ["tx_id", "parcel_id"], ["tx_date", "price"]))
    assert plan.count("WindowGroupLimit") == 2


def test_median_filters_values_before_the_shuffle(spark):
    """The values inside the brackets are kept by a broadcast join under which there is no exchange of values."""
    sales = P.positive_sales(B.transactions(spark, "/root/testdata/sf0.1"))
    values = {name: F.col(name) for name in ("price", "built")}
    df = grouped_median(sales, ["city_id"], values)
    plan = _tree(df)
    at = next(n for n, line in enumerate(plan.split("\n")) if "BroadcastHashJoin" in line)
    below = plan.split("\n")[at + 1 :]
    depth = len(plan.split("\n")[at]) - len(plan.split("\n")[at].lstrip(" :+-"))
    nested = [line for line in below[: next((n for n, line in enumerate(below) if len(line) - len(line.lstrip(" :+-")) <= depth), len(below))]]
    assert not any("Exchange hashpartitioning" in line for line in nested)
    expected = {tuple(r) for r in df.collect()}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {tuple(r) for r in grouped_median(sales, ["city_id"], values).collect()} == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
