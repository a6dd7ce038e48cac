"""Runs registered queries next to their SQL and compares the results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return db


def _plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sorted_rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
}


def compare(spark, db, sf: str, name: str, query, text: str) -> str:
    """Empty when equal, else what differs."""
    got = query(spark, sf)
    found = db.execute(text)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    expected = _sorted_rows(found.fetchall(), names)
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    mine = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in got.schema}
    problem = "" if mine == kinds else f"types {[(n, mine[n], kinds[n]) for n in mine if mine[n] != kinds[n]]}"
    rows = _sorted_rows([tuple(r) for r in got.collect()], got.columns)
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)} {problem}"
    for mine_row, their_row in zip(rows, expected):
        if mine_row != their_row:
            return f"first difference {sorted(names)}: {mine_row} != {their_row} {problem}"
    return problem


def main() -> None:
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from camlytics.session import local_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark, db = local_session(), connect(sf)
    sqls = e.oracle_sql()
    for name, query in e.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            if name in sqls:
                result = compare(spark, db, sf, name, query, sqls[name]) or "ok"
            else:
                result = f"rows only: {len(query(spark, sf).collect())}"
        except Exception as problem:
            result = f"FAILED {type(problem).__name__}: {str(problem)[:600]}"
        print(f"{name:34s} {time.time() - started:6.2f}s {result[:900]}", flush=True)


if __name__ == "__main__":
    main()
