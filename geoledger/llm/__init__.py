"""Operators of a training-data pipeline: de-duplication, filtering, mixing, scoring, tokens, sharding."""
