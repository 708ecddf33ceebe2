"""Run registered queries on Spark and their SQL twins on DuckDB and compare the rows."""

from __future__ import annotations

import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row))


def difference(df, con, sql: str) -> str | None:
    """None when both give the same rows, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    wrong = {c: (types[c], kinds[c]) for c in names if types[c] != kinds[c]}
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ, first: {bad[0][0]} != {bad[0][1]}"
    return f"types {wrong}" if wrong else None


def main(sf_dir: str, prefixes: list[str]) -> None:
    from tests.session import session

    import __spark_entry__ as entry

    spark = session()
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                problem = difference(df, con, sql[name])
                note = "same"
            else:
                problem, note = None, f"{len(df.collect())} rows, no SQL twin"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{time.time() - start:6.2f}s {name}: {problem or note}", flush=True)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
