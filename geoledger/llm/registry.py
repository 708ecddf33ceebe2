"""Queries and SQL of this subpackage by name."""

from geoledger.llm import (
    counts, gridcodes, language, lattice, mixing, negatives, pieces, quality, repeats, sharding, simhash, urls, winnowing,
)

MODULES = (lattice, urls, mixing, language, simhash, pieces, counts, winnowing, sharding, quality, gridcodes, repeats, negatives)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
