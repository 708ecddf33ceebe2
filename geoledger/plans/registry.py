"""All registered queries by name."""

from geoledger.plans import checks, ingest, maps, properties, texts

MODULES = (properties, texts, maps, checks, ingest)


def queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}
