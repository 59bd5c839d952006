"""Row-for-row comparison of the registered queries with their SQL."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


# Spark type names and the DuckDB types that hold the same values.
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def spark_rows(df) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(row) for row in df.select(*names).collect()), key=repr)


def duck_rows(con, sql: str) -> tuple[dict[str, str], list[tuple]]:
    """Column types by name, and the rows with their columns sorted by name."""
    cursor = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(range(len(types)), key=lambda i: list(types)[i])
    rows = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    return types, sorted(rows, key=repr)


def difference(spark, con, sf_dir: str, query, sql: str) -> str | None:
    df = query(spark, sf_dir)
    got, (types, want) = spark_rows(df), duck_rows(con, sql)
    mine = {name: SAME_TYPE[kind] for name, kind in df.dtypes}
    if mine != types:
        return f"columns {sorted(set(mine.items()) ^ set(types.items()))} differ"
    if not want:
        return "the expected result is empty"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            return f"{sorted(types)}: {a!r} != {b!r}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark, con = make_session(), duck(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, query, oracle[name]) if name in oracle else "no oracle"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print("bad:", bad)
