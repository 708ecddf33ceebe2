"""Data-quality reports: presence, completeness, consistency, ranges, anomalies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoledger import constants as C
from geoledger.functions.numbers import percent, ratio, round_half_even, round_half_up


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- presence and profile -----------------------------------------------------------------------


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table, rows) line per table."""
    return _union(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    )


def require_nonempty(tables: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Counts of the required inputs; with ``strict`` an empty one fails the query."""
    counts = table_counts(tables).withColumn("present", F.col("rows") > 0)
    if strict:
        failed = F.raise_error(F.concat(F.lit("empty input: "), "table"))
        counts = counts.withColumn("present", F.when(F.col("present"), F.lit(True)).otherwise(failed))
    return counts


def profile(tables: dict[str, DataFrame], pattern: str | None = None) -> DataFrame:
    """One line per (table, column) whose name contains ``pattern``: type, row count, any row as an example."""

    def lines(name: str, df: DataFrame) -> DataFrame:
        columns = [f for f in df.schema.fields if pattern is None or pattern in f.name]
        example = df.limit(1).select(F.to_json(F.struct("*")).alias("example")).scalar()
        rows = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("example", example)
        listed = F.array(
            *[F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")) for f in columns]
        )
        if not columns:
            listed = F.array().cast("array<struct<column:string,type:string>>")
        return rows.select(F.lit(name).alias("table"), F.inline(listed), "rows", "example")

    return _union([lines(name, df) for name, df in tables.items()])


def count_ranges(tables: dict[str, DataFrame], ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Row counts with their expected range."""
    limits = F.create_map(
        *[x for name, (lo, hi) in ranges.items() for x in (F.lit(name), F.array(F.lit(lo), F.lit(hi)))]
    )
    rows = table_counts({name: tables[name] for name in ranges})
    limit = limits[F.col("table")]
    return rows.select(
        "table", "rows", limit[0].alias("low"), limit[1].alias("high"), F.col("rows").between(limit[0], limit[1]).alias("ok")
    )


# --- reviews ------------------------------------------------------------------------------------


def review_totals(cities: DataFrame, reviews: DataFrame) -> DataFrame:
    marks = cities.select(F.lit(1).alias("c"), F.lit(0).alias("r")).unionByName(
        reviews.select(F.lit(0).alias("c"), F.lit(1).alias("r"))
    )
    sums = marks.agg(F.sum("c").alias("cities"), F.sum("r").alias("reviews"))
    mean = F.coalesce(round_half_up(ratio(F.col("reviews"), F.col("cities")), 2), F.lit(0.0))
    return sums.withColumn("reviews_per_city", mean)


def reviews_per_city(reviews: DataFrame) -> DataFrame:
    counts = reviews.groupBy("city_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min("n").alias("minimum"), F.max("n").alias("maximum"), round_half_up(F.avg("n"), 2).alias("mean")
    )


def orphan_city_ids(reviews: DataFrame, cities: DataFrame) -> DataFrame:
    """City ids of reviews that no city has."""
    return reviews.select("city_id").distinct().join(cities.select("city_id"), "city_id", "left_anti")


def cities_without_reviews(cities: DataFrame, reviews: DataFrame) -> DataFrame:
    reviewed = reviews.select("city_id").distinct()
    return cities.join(reviewed, "city_id", "left_anti").select("city_id", "name")


def cities_counted_empty(cities: DataFrame) -> DataFrame:
    """The same question asked of the stored counter."""
    return cities.where(F.col("review_count") == 0).select("city_id", "name")


def score_gaps(reviews: DataFrame, cities: DataFrame, gap: float = 0.5, k: int | None = 10) -> DataFrame:
    """Cities whose stored mean is further than ``gap`` from the mean of their reviews; the ``k`` worst in order, or all."""
    actual = reviews.groupBy("city_id").agg(F.avg("score").alias("computed"), F.count(F.lit(1)).alias("reviews"))
    stored = cities.select("city_id", "name", F.col("scores.mean").alias("stored"))
    found = (
        actual.join(stored, "city_id", "left")
        .withColumn("difference", F.abs(F.col("computed") - F.col("stored")))
        .where(F.col("difference") > gap)
        .select(
            "city_id",
            "name",
            "reviews",
            round_half_up(F.col("computed"), 4).alias("computed"),
            "stored",
            round_half_up(F.col("difference"), 4).alias("difference"),
        )
    )
    return found if k is None else found.orderBy(F.desc("difference"), F.asc("city_id")).limit(k)


def missing_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows without each field (nested fields by path), in one pass; a column the table lacks counts fully."""

    def known(path: str) -> bool:
        kind: T.DataType = df.schema
        for step in path.split("."):
            if not isinstance(kind, T.StructType) or step not in kind.names:
                return False
            kind = kind[step].dataType
        return True

    counted = [
        (F.count_if(F.col(path).isNull()) if known(path) else F.count(F.lit(1))).alias(f"m{i}")
        for i, path in enumerate(fields)
    ]
    lines = [F.struct(F.lit(path).alias("field"), F.col(f"m{i}").alias("missing")) for i, path in enumerate(fields)]
    return df.agg(*counted).select(F.inline(F.array(*lines)))


def empty_descriptions(reviews: DataFrame) -> DataFrame:
    return reviews.agg(F.count_if(F.col("description") == "").alias("empty_descriptions"))


def score_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per score rounded half to even, with their share in percent."""
    buckets = reviews.groupBy(round_half_even(F.col("score"), 0).cast("int").alias("score")).agg(
        F.count(F.lit(1)).alias("reviews")
    )
    total = F.sum("reviews").over(W.partitionBy())  # one row per score
    return buckets.select("score", "reviews", percent(F.col("reviews"), total, 2).alias("share"))


def category_means(reviews: DataFrame) -> DataFrame:
    """Mean of each category over all reviews; a missing category was stored as 0 and counts."""
    means = [round_half_up(F.avg(F.coalesce(name, F.lit(0.0))), 2).alias(name) for name in C.CATEGORIES]
    lines = [F.struct(F.lit(name).alias("category"), F.col(name).alias("mean")) for name in C.CATEGORIES]
    return reviews.agg(*means).select(F.inline(F.array(*lines)))


def issues(cities: DataFrame, reviews: DataFrame, examples: int = 5, gap: float = 0.5) -> DataFrame:
    """Problems found, their full count, their severity and a few examples; no line for a problem that is absent."""

    def line(rows: DataFrame, kind: str, severity: str, order: str, example: Column) -> DataFrame:
        shown = rows.orderBy(order if order == "city_id" else F.desc(order), "city_id").limit(examples)
        texts = shown.agg(F.sort_array(F.collect_list(example)).alias("examples"))
        return (
            rows.agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 0)
            .select(
                F.lit(kind).alias("type"),
                F.lit(severity).alias("severity"),
                "n",
                F.array_join(texts.scalar(), "; ").alias("examples"),
            )
        )

    gaps = score_gaps(reviews, cities, gap, None)
    return _union(
        [
            line(cities_counted_empty(cities), "cities_without_reviews", "medium", "city_id", F.col("city_id")),
            line(gaps, "score_gaps", "high", "difference", F.col("city_id")),
        ]
    )


# --- property statistics ------------------------------------------------------------------------


def rollup_mismatches(children: DataFrame, parents: DataFrame, level: str) -> DataFrame:
    """Parents whose sales total differs from the sum over their children."""
    key = f"{level}_id"
    sums = children.groupBy(key).agg(F.sum("transactions").alias("children_total"))
    return (
        parents.select(key, "name", F.col("transactions").alias("total"))
        .join(sums, key, "left")
        .where(F.abs(F.col("total") - F.col("children_total")) > 0)
        .select(F.lit(level).alias("level"), F.col(key).alias("area_id"), "name", "total", "children_total")
    )


def price_sanity(stats: DataFrame, extreme: float = 50_000) -> DataFrame:
    price = F.col("price_mean")
    return stats.where(price.isNotNull()).agg(
        F.count(F.lit(1)).alias("cities"),
        F.count_if(price < 0).alias("negative_prices"),
        F.count_if(price > extreme).alias("extreme_prices"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        round_half_up(F.avg(price), 2).alias("mean_price"),
    )


def level_summary(levels: dict[str, DataFrame]) -> DataFrame:
    """Count and spread of sales and prices per level."""
    zero = F.lit(0.0)
    parts = [
        stats.where(F.col("transactions") > 0)
        .agg(
            F.count(F.lit(1)).alias("areas"),
            F.coalesce(round_half_up(F.avg("transactions"), 2), zero).alias("mean_transactions"),
            F.coalesce(F.min("transactions"), F.lit(0).cast("bigint")).alias("min_transactions"),
            F.coalesce(F.max("transactions"), F.lit(0).cast("bigint")).alias("max_transactions"),
            F.coalesce(round_half_up(F.avg("price_mean"), 2), zero).alias("mean_price"),
            F.coalesce(F.min("price_mean"), zero).alias("min_price"),
            F.coalesce(F.max("price_mean"), zero).alias("max_price"),
        )
        .withColumn("level", F.lit(level))
        for level, stats in levels.items()
    ]
    return _union(parts)


# --- review documents ---------------------------------------------------------------------------

_REQUIRED = {
    "department": {
        "department_id": T.StringType, "name": T.StringType, "region_id": T.StringType, "cities": T.LongType,
        "reviews": T.LongType, "scores": T.StructType, "sentiment": T.StructType, "words": T.ArrayType,
    },
    "region": {
        "region_id": T.StringType, "name": T.StringType, "departments": T.LongType, "cities": T.LongType,
        "reviews": T.LongType, "scores": T.StructType, "sentiment": T.StructType, "words": T.ArrayType,
        "department_list": T.ArrayType,
    },
}


def _structure(docs: DataFrame, level: str) -> bool:
    kinds = {field.name: type(field.dataType) for field in docs.schema.fields}
    return all(kinds.get(name) is kind for name, kind in _REQUIRED[level].items())


def _count_match(docs: DataFrame, areas: DataFrame) -> DataFrame:
    marks = docs.select(F.lit(1).alias("side")).unionByName(areas.select(F.lit(-1).alias("side")))
    return marks.agg((F.coalesce(F.sum("side"), F.lit(0)) == 0).alias("ok"))


def _check(name: str, df: DataFrame) -> DataFrame:
    return df.select(F.lit(name).alias("check"), "ok")


def _none(rows: DataFrame) -> DataFrame:
    return rows.agg((F.count(F.lit(1)) == 0).alias("ok"))


def validate_departments(docs: DataFrame, departments: DataFrame) -> DataFrame:
    """Count against the reference table, document structure, region codes."""
    known = departments.select("department_id", F.col("region_id").alias("expected"))
    wrong = docs.join(known, "department_id").where(F.col("region_id") != F.col("expected"))
    return _union(
        [
            _check("department_count_match", _count_match(docs, departments)),
            _check("department_structure", docs.agg(((F.count(F.lit(1)) > 0) & F.lit(_structure(docs, "department"))).alias("ok"))),
            _check("department_region_match", _none(wrong)),
        ]
    )


def validate_regions(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """Count against the reference table, document structure, length of the department list."""
    wrong = docs.where(F.size("department_list") != F.col("departments"))
    return _union(
        [
            _check("region_count_match", _count_match(docs, regions)),
            _check("region_structure", docs.agg(((F.count(F.lit(1)) > 0) & F.lit(_structure(docs, "region"))).alias("ok"))),
            _check("region_list_match", _none(wrong)),
        ]
    )


def score_checks(department_docs: DataFrame, region_docs: DataFrame, hi: float = 10) -> DataFrame:
    """Scores within range and sentiment shares adding up, per level."""
    shares = [F.col(f"sentiment.{name}_percent") for name in C.SENTIMENTS]
    whole = round_half_even(shares[0] + shares[1] + shares[2], 0) == 100
    parts = []
    for level, docs in (("department", department_docs), ("region", region_docs)):
        in_range = F.coalesce(F.col("scores.mean").between(0, hi), F.lit(False))
        uneven = docs.where((F.col("sentiment.positive") > 0) & ~whole)
        parts += [
            _check(f"{level}_scores_in_range", _none(docs.where(~in_range))),
            _check(f"{level}_shares_add_up", _none(uneven)),
        ]
    return _union(parts)


def review_rollup_check(cities: DataFrame, department_docs: DataFrame, region_docs: DataFrame) -> DataFrame:
    """Review and city totals compared between neighbouring levels."""
    totals = _union(
        [
            cities.agg(F.sum("review_count").alias("reviews"), F.count(F.lit(1)).alias("cities")).withColumn("level", F.lit("city")),
            *[
                docs.agg(F.sum("reviews").alias("reviews"), F.sum("cities").alias("cities")).withColumn("level", F.lit(level))
                for level, docs in (("department", department_docs), ("region", region_docs))
            ],
        ]
    )

    def at(level: str, name: str) -> Column:
        return F.max(F.when(F.col("level") == level, F.col(name)))

    checks = [
        F.struct(
            F.lit(f"{name}_{lower}_{upper}").alias("check"),
            F.col(f"{lower}_{name}").alias("lower"),
            F.col(f"{upper}_{name}").alias("upper"),
            F.col(f"{lower}_{name}").eqNullSafe(F.col(f"{upper}_{name}")).alias("ok"),
        )
        for lower, upper in (("city", "department"), ("department", "region"))
        for name in ("reviews", "cities")
    ]
    wide = totals.agg(*[at(level, name).alias(f"{level}_{name}") for level in C.LEVELS for name in ("reviews", "cities")])
    return wide.select(F.inline(F.array(*checks)))


def anomalies(department_docs: DataFrame, region_docs: DataFrame) -> DataFrame:
    """Empty areas, extreme scores, one-sided sentiment, odd words (the first of each department)."""

    def line(rows: DataFrame, kind: str, detail: Column) -> DataFrame:
        return rows.select(F.lit(kind).alias("type"), "name", detail.alias("detail"))

    nothing = F.lit(None).cast("string")
    mean = F.col("scores.mean")
    extreme = department_docs.where((mean < 2) | (mean > 9))
    one_sided = region_docs.where(
        (F.col("sentiment.positive_percent") == 100) | (F.col("sentiment.negative_percent") == 100)
    )
    odd = lambda item: (F.length(item["word"]) < 2) | (F.length(item["word"]) > 30)
    strange = (
        department_docs.select("department_id", "name", F.get(F.filter("words", odd), F.lit(0)).alias("item"))
        .where(F.col("item").isNotNull())
    )
    return _union(
        [
            line(department_docs.where(F.col("cities") == 0), "department_without_cities", nothing),
            line(region_docs.where(F.col("departments") == 0), "region_without_departments", nothing),
            line(extreme, "extreme_score", mean.cast("string")),
            line(
                one_sided,
                "one_sided_sentiment",
                F.concat_ws("/", "sentiment.positive_percent", "sentiment.negative_percent"),
            ),
            line(strange, "odd_word", F.col("item.word")),
        ]
    )


def text_job_stats(cities: DataFrame, city_docs: DataFrame) -> DataFrame:
    """Progress of the text job and averages over its documents."""
    zero_n, none = F.lit(0).cast("bigint"), F.lit(None).cast("double")
    shares = {name: F.col(f"sentiment.{name}_percent") for name in C.SENTIMENTS}
    marks = cities.select(
        F.lit(1).alias("city"),
        F.when(F.col("status") == "processed", 1).otherwise(0).alias("done"),
        F.lit(0).alias("doc"),
        zero_n.alias("words"),
        *[none.alias(name) for name in shares],
    ).unionByName(
        city_docs.select(
            F.lit(0).alias("city"),
            F.lit(0).alias("done"),
            F.lit(1).alias("doc"),
            F.size("words").cast("bigint").alias("words"),
            *[share.alias(name) for name, share in shares.items()],
        )
    )
    sums = marks.agg(
        F.sum("city").alias("cities"),
        F.sum("done").alias("processed"),
        F.sum("doc").alias("documents"),
        F.sum("words").alias("words"),
        *[round_half_up(F.avg(name), 2).alias(f"{name}_mean") for name in shares],
    )
    return sums.select(
        "cities",
        "processed",
        percent(F.col("processed"), F.col("cities"), 2).alias("processed_share"),
        "words",
        F.coalesce(round_half_up(ratio(F.col("words"), F.col("documents")), 2), F.lit(0.0)).alias("words_per_city"),
        *[f"{name}_mean" for name in shares],
    )


def global_sentiment(department_docs: DataFrame) -> DataFrame:
    sums = department_docs.agg(*[F.coalesce(F.sum(f"sentiment.{n}"), F.lit(0)).alias(n) for n in C.SENTIMENTS])
    total = F.col("positive") + F.col("neutral") + F.col("negative")
    return sums.select(*[percent(F.col(name), total).alias(name) for name in C.SENTIMENTS])


def general_stats(cities: DataFrame, reviews: DataFrame, department_docs: DataFrame, region_docs: DataFrame) -> DataFrame:
    """Row counts of the four collections as one line."""
    tables = {"cities": cities, "reviews": reviews, "departments": department_docs, "regions": region_docs}
    counts = table_counts(tables)
    return counts.agg(*[F.max(F.when(F.col("table") == name, F.col("rows"))).alias(name) for name in tables])


def summary_json(groups: dict[str, DataFrame]) -> DataFrame:
    """One document with an object per group of metrics; a group is one line (none: null), more fail the query."""

    def only(name: str, metrics: DataFrame) -> Column:
        line = F.when(F.count(F.lit(1)) <= 1, F.first(F.struct("*"))).otherwise(
            F.raise_error(F.lit(f"more than one line of metrics in group {name}"))
        )
        return metrics.agg(line.alias(name)).scalar().alias(name)

    one = next(iter(groups.values())).sparkSession.range(1)
    document = F.struct(*[only(name, metrics) for name, metrics in groups.items()])
    return one.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))
