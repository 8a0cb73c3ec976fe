"""Compare registered queries with their SQL twins in DuckDB.

Run as a script: python -m tests.oracle SF_DIR [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sort_key(row):
    return tuple((v is None, type(v).__name__, str(v)) for v in row)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, float]:
    """"" or the difference, and the seconds Spark took."""
    from starloom.queries import ORACLES, QUERIES

    begin = time.time()
    df = QUERIES[name](spark, sf_dir)
    order = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in order) for r in df.collect()]
    seconds = time.time() - begin
    if name not in ORACLES:
        return "", seconds
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != order:
        return f"columns {order} vs {sorted(names)}", seconds
    at = [names.index(c) for c in order]
    wanted = [tuple(_norm(r[i]) for i in at) for r in result.fetchall()]
    for column, kind in df.dtypes:
        if DUCK_TYPES.get(kind, kind) != kinds[column]:
            return f"type of {column}: {kind} vs {kinds[column]}", seconds
    if len(rows) != len(wanted):
        return f"{len(rows)} rows vs {len(wanted)}", seconds
    rows.sort(key=_sort_key)
    wanted.sort(key=_sort_key)
    for ours, theirs in zip(rows, wanted):
        if ours != theirs:
            return f"{order}: {str(ours)[:300]} vs {str(theirs)[:300]}", seconds
    return ("no rows" if not rows else ""), seconds


def main() -> int:
    from starloom.queries import ORACLES, QUERIES
    from tests.conftest import make_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark, con = make_session(), connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        try:
            difference, seconds = compare(spark, con, name, sf_dir)
        except Exception as error:
            difference, seconds = f"{type(error).__name__}: {str(error)[:600]}", 0.0
            if names:
                traceback.print_exc()
        failed += bool(difference)
        mark = "FAIL" if difference else ("ok" if name in ORACLES else "ok (rows only)")
        print(f"{mark:5} {name:34} {seconds:6.2f}s {difference}", flush=True)
    print(f"{failed} failed of {len(names or QUERIES)}; {len(ORACLES)} have an SQL twin")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
