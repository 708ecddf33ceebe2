"""Fixtures: documents with every odd case, and plain-Python components."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"

LONG = " ".join(f"word{i % 977}" for i in range(60_000))


def odd_documents(spark):
    """Nulls in every column, empty and blank texts, repeated rows, equal texts, one very long text, odd characters."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
        (2, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
        (2, "The quick brown fox jumps over the lazy dog again and again.", "en", "a", 60),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n ", "en", None, 4),
        (6, "x", None, "b", 1),
        (7, LONG, "en", "c", len(LONG)),
        (8, "日本語 😀😀  two  spaces\n\nand <s> ▁ marks <|endoftext|> é", "ja", "c", 40),
        (None, "a document without a number", "en", "c", 27),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


def clashing(docs):
    """Columns named like those that operators add or use inside."""
    from pyspark.sql import functions as F

    names = ["score", "shard", "slot", "copy", "n_copies", "mix_key", "host", "verdict", "id", "fp", "key", "digest", "part", "row", "size", "predicted"]
    names += ["_cdf", "_parts", "_rate_source", "wanted", "cdf", "parts", "weight", "_row", "_kept", "place", "root", "component_id", "fingerprint"]
    names += ["_host", "_day", "pattern", "valid_from", "valid_to", "list_name", "kind", "path", "_id", "_text", "_part", "_draw", "_quality"]
    return docs.withColumns({n: F.lit("clash") for n in names})


def plain_components(n: int, links) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
