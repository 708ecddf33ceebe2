"""Insert-if-absent, upserts, incremental state and deletes as joins between old and new rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoledger import constants as C
from geoledger.functions.codes import is_city_url


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each key; tasks keep one row per key before the shuffle."""
    ranked = W.partitionBy(*keys).orderBy(*[F.asc_nulls_first(name) for name in order])
    return df.withColumn("_rn", F.row_number().over(ranked)).where(F.col("_rn") == 1).drop("_rn")


def absent_rows(new: DataFrame, existing: DataFrame | None, keys: list[str], order: list[str]) -> DataFrame:
    """The first new row of each key that is not stored.

    Equal rows tie on every order column, so picking the first per key also removes copies.
    """
    first = first_per_key(new, keys, order)
    return first if existing is None else first.join(existing.select(*keys), keys, "left_anti")


def dedup_insert(new: DataFrame, existing: DataFrame | None, keys: list[str], order: list[str]) -> DataFrame:
    """Stored rows plus the first new row of each absent key (``absent_rows``)."""
    added = absent_rows(new, existing, keys, order)
    return added if existing is None else existing.unionByName(added)


def _full_join(new: DataFrame, existing: DataFrame, keys: list[str]) -> tuple[DataFrame, Column, Column]:
    n = new.withColumn("_new", F.lit(True)).alias("n")
    e = existing.withColumn("_old", F.lit(True)).alias("e")
    return n.join(e, keys, "full_outer"), F.col("_new").isNotNull(), F.col("_old").isNotNull()


def upsert_columns(new: DataFrame, existing: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """New keys are inserted whole; on known keys only ``cols`` take the new value."""
    both, is_new, is_old = _full_join(new, existing, keys)

    def value(name: str) -> Column:
        if name in cols:
            return F.when(is_new, F.col(f"n.{name}")).otherwise(F.col(f"e.{name}"))
        return F.when(is_old, F.col(f"e.{name}")).otherwise(F.col(f"n.{name}"))

    return both.select(*[F.col(c) if c in keys else value(c).alias(c) for c in existing.columns])


def upsert_replace(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of known keys are replaced, the others stay."""
    return existing.join(new.select(*keys), keys, "left_anti").unionByName(new)


def upsert_merge(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Given fields are set, fields the new document lacks keep their stored value."""
    both, _, _ = _full_join(new, existing, keys)
    names = list(dict.fromkeys([*existing.columns, *new.columns]))

    def value(name: str) -> Column:
        sides = [f"{side}.{name}" for side, df in (("n", new), ("e", existing)) if name in df.columns]
        return F.coalesce(*sides)

    return both.select(*[F.col(c) if c in keys else value(c).alias(c) for c in names])


# --- processing state ---------------------------------------------------------------------------


def unprocessed(cities: DataFrame) -> DataFrame:
    """Cities flagged "unprocessed" or without a flag."""
    return cities.where(F.col("status").isNull() | (F.col("status") == "unprocessed"))


def mark_processed(df: DataFrame, ids: DataFrame, when: Column | None = None) -> DataFrame:
    """Set state and time on the rows of the given cities, whether or not they have reviews."""
    done = ids.select("city_id").distinct().withColumn("_done", F.lit(True))
    return (
        df.join(done, "city_id", "left")
        .withColumns(
            {
                "status": F.when(F.col("_done"), "processed").otherwise(F.col("status")),
                "processed_at": F.when(F.col("_done"), F.current_timestamp() if when is None else when).otherwise(
                    F.col("processed_at")
                ),
            }
        )
        .drop("_done")
    )


def requeue_stale(state: DataFrame, before: datetime | Column) -> DataFrame:
    """Rows processed before a date go back to "unprocessed"."""
    stale = F.col("processed_at") < F.lit(before)
    return state.withColumn("status", F.when(stale, "unprocessed").otherwise(F.col("status")))


# --- deletes and address sets -------------------------------------------------------------------


def purge_invalid(
    cities: DataFrame, reviews: DataFrame, dry_run: bool = True, pattern: str = C.CITY_URL
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Remove pages with an invalid address and the reviews that stand on them.

    Reviews carry the address of their page (``url``): a quarter stored under the id of its city takes
    its own reviews along, not the city's.  Reviews without an address stay.  A dry run returns the
    two counts; otherwise the remaining pages and reviews.
    """
    valid = is_city_url(F.col("url"), pattern)
    invalid = cities.where(~valid).select("url").distinct()
    if dry_run:
        lost = reviews.join(invalid, "url", "left_semi")
        counts = [
            cities.where(~valid).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("cities").alias("item"), "rows"),
            lost.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("reviews").alias("item"), "rows"),
        ]
        return counts[0].unionByName(counts[1])
    return cities.where(valid), reviews.join(invalid, "url", "left_anti")


def new_urls(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Addresses not stored yet."""
    return found.select("url").subtract(stored.select("url"))


def known_urls(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Addresses already stored."""
    return found.select("url").intersect(stored.select("url"))


def cap(df: DataFrame, n: int, order: str) -> DataFrame:
    """First ``n`` rows in key order; 0 keeps all."""
    return df if n == 0 else df.orderBy(order).limit(n)
