"""Codes, levels, dates, addresses and short texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoledger import constants as C


def level_for_zoom(zoom: Column) -> Column:
    """Aggregation level shown at a map zoom."""
    return (
        F.when(zoom <= C.REGION_ZOOM, "region")
        .when(zoom <= C.DEPARTMENT_ZOOM, "department")
        .otherwise("city")
    )


def date_text(col: Column) -> Column:
    """``yyyy-MM-dd``; text input is parsed first, unreadable text gives null."""
    return F.date_format(F.try_to_date(F.substring(col.cast("string"), 1, 10), "yyyy-MM-dd"), "yyyy-MM-dd")


def is_city_url(url: Column, pattern: str = C.CITY_URL) -> Column:
    return F.coalesce(url.rlike(pattern), F.lit(False))


def url_class(url: Column, pattern: str = C.CITY_URL) -> Column:
    return (
        F.when(is_city_url(url, pattern), "valid")
        .when(url.contains(C.QUARTER_MARK), "quarter")
        .when(F.lower(url).contains(C.DISTRICT_MARK), "district")
        .otherwise("other")
    )


def city_code(url: Column) -> Column:
    """City code carried by a review address, "" when there is none."""
    return F.coalesce(F.regexp_extract(url, C.CITY_CODE_IN_URL, 1), F.lit(""))


def department_of(code: Column) -> Column:
    """First two characters; three for overseas codes (97x); "" for shorter codes."""
    return (
        F.when(F.length(code) < 2, "")
        .when(code.startswith("97") & (F.length(code) >= 3), F.substring(code, 1, 3))
        .otherwise(F.substring(code, 1, 2))
    )


def score_text(col: Column) -> Column:
    """``4.2/5`` as 4.2; unreadable or missing text counts as 0."""
    return F.coalesce(F.trim(F.split(col, "/")[0]).try_cast("double"), F.lit(0.0))


def review_count(col: Column) -> Column:
    """Number announced as "sur N commentaires", 0 when absent."""
    return F.coalesce(F.regexp_extract(col, C.REVIEW_COUNT, 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def score_field(label: Column) -> Column:
    """Score field a category label stands for, null for other labels."""
    text = F.lower(label)
    field = F.lit(None).cast("string")
    for name, part in reversed(C.CATEGORY_LABELS.items()):
        field = F.when(text.contains(part), name).otherwise(field)
    return field


def truncate_text(col: Column, limit: int = 100) -> Column:
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit - 3), F.lit("..."))).otherwise(col)


def sentiment(score: Column) -> Column:
    """Class of an overall score; a missing score counts as 0."""
    known = F.coalesce(score, F.lit(0.0))
    return (
        F.when(known >= C.POSITIVE_FROM, "positive")
        .when(known <= C.NEGATIVE_UPTO, "negative")
        .otherwise("neutral")
    )
