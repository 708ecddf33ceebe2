"""All SQL twins by query name."""

from oracle import checks, ingest, maps, properties, texts

MODULES = (properties, texts, maps, checks, ingest)


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
