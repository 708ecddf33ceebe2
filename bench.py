"""Time the headline queries and print one JSON line.

``$BENCH_SF_DIR`` holds the tables, ``$BENCH_CPUS`` the number of local cores.  Each query runs once to
warm up and then ``$BENCH_RUNS`` times; the best run counts.  The ``map_*`` and ``listing`` queries read
stored statistics, as an interactive map does; storing them is ``property_rollup``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("geoledger-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from geoledger.operators import areas as M
    from geoledger.operators import quality as V
    from geoledger.operators import rankings as K
    from geoledger.operators import reviews as R
    from geoledger.plans import inputs as I
    from geoledger.plans import registry
    from geoledger.sources import bindings as B
    from geoledger.sources.scratch import materialise

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session(cpus)
    queries = registry.queries()

    names = (
        "a1_city_stats", "a3_region_stats", "a4_property_rollup", "u1_dedup_insert", "s1_transaction_csv",
        "j17_points_in_areas", "k1_recent_transactions", "w1_city_sentiment", "w2_city_words",
        "r3_department_documents", "r7_region_documents", "s2_city_geojson", "p21_city_rows",
    )
    timed = {name: (lambda name=name: run(queries[name](spark, sf_dir))) for name in names}

    stats = {level: materialise(df, level) for level, df in I.all_stats(spark, sf_dir).items()}
    sources = {"city": B.cities, "department": B.department_areas, "region": B.region_areas}
    levels = {level: (materialise(source(spark, sf_dir), f"{level}-areas"), stats[level]) for level, source in sources.items()}
    ratings = materialise(B.city_documents(spark, sf_dir), "ratings")
    reviews = materialise(B.reviews(spark, sf_dir), "reviews")
    city_docs = I.stored_city_word_docs(spark, sf_dir)
    department_docs = materialise(R.department_documents(city_docs, ratings, B.departments(spark, sf_dir)), "departments")
    region_docs = materialise(R.region_documents(department_docs, B.regions(spark, sf_dir)), "regions")

    views = {"region": I.REGION_VIEW, "department": I.DEPARTMENT_VIEW, "city": I.CITY_VIEW}
    for level, view in views.items():
        timed[f"map_{level}"] = lambda view=view: run(M.areas_in_viewport(levels, ratings, view))
    timed["listing"] = lambda: run(M.area_listing(levels))

    def property_validation() -> None:
        run(V.rollup_mismatches(stats["city"], stats["department"], "department"))
        run(V.rollup_mismatches(stats["department"], stats["region"], "region"))
        run(V.price_sanity(stats["city"]))
        run(V.level_summary(stats))
        run(K.top_cities(stats["city"], "n"))
        run(K.top_cities(stats["city"], "price"))
        run(K.top_departments(stats["department"], B.departments(spark, sf_dir)))

    def review_validation() -> None:
        run(V.general_stats(ratings, reviews, department_docs, region_docs))
        run(V.validate_departments(department_docs, B.departments(spark, sf_dir)))
        run(V.validate_regions(region_docs, B.regions(spark, sf_dir)))
        run(V.score_checks(department_docs, region_docs))
        run(V.review_rollup_check(ratings, department_docs, region_docs))
        run(V.anomalies(department_docs, region_docs))

    timed["property_validation"] = property_validation
    timed["review_validation"] = review_validation

    seconds: dict[str, float] = {}
    for name, action in timed.items():
        action()
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            action()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
