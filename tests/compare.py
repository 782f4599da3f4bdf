"""Compare every query with its SQL on the same tables: ``python -m tests.compare DIR [names]``."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, sf_dir: str, query, sql: str) -> str:
    """Empty when both sides agree, else a short description."""
    df = query(spark, sf_dir)
    found = _table(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    wanted = _table([c[0] for c in result.description], result.fetchall())
    if found[0] != wanted[0]:
        return f"columns {found[0]} and {wanted[0]}"
    if found[1] == wanted[1]:
        return ""
    left, right = set(found[1]), set(wanted[1])
    return (f"rows {len(found[1])} and {len(wanted[1])} of {found[0]}; only query {sorted(left - right)[:2]}; "
            f"only SQL {sorted(right - left)[:2]}")


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as contract
    from tests.conftest import session

    spark, con = session(), connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            text = difference(spark, con, sf_dir, queries[name], oracles[name]) if name in oracles else "no SQL"
        except Exception as error:  # report and go on with the next one
            text = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(text) and text != "no SQL"
        print(f"{name:28s} {time.time() - start:6.2f}s {text or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
