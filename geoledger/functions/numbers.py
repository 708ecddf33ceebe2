"""Rounding and ratio rules shared by every report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(col: Column, digits: int) -> Column:
    """Half away from zero on the decimal value, so a tie does not depend on binary noise."""
    return F.round(col.try_cast("decimal(30,6)"), digits).cast("double")


def round_half_even(col: Column, digits: int) -> Column:
    return F.bround(col.try_cast("decimal(30,6)"), digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, null when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, 0 when ``whole`` is 0."""
    return F.coalesce(round_half_up(ratio(part, whole) * 100, digits), F.lit(0.0))


def rounded(name: str, digits: int) -> Column:
    """``round_half_up`` of a column under its own name."""
    return F.expr(f"double(round(try_cast({name} AS decimal(30,6)), {digits})) AS {name}")


def weighted_mean(value: str, weight: str) -> Column:
    """Aggregate: sum(value * weight) / sum(weight); a null value still counts in the divisor."""
    used = f"CASE WHEN {weight} > 0 THEN {weight} END"
    return F.expr(f"try_divide(double(sum({value} * {used})), double(sum({used})))")


def struct_of(fields: dict[str, Column]) -> Column:
    return F.struct(*[col.alias(name) for name, col in fields.items()])
