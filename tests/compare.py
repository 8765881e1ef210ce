"""Run registered queries against their SQL and report every difference."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else ("nan" if math.isnan(value) else value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _bag(rows, order) -> Counter:
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark, folder: str, name: str, query, sql: str) -> str | None:
    """None when schema and rows agree, else what differs."""
    df = query(spark, folder)
    rows = df.collect()
    result = connect(folder).execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for field in df.schema:
        want = TYPES[field.dataType.simpleString()]
        if types[field.name] != want:
            return f"type of {field.name}: {want} != {types[field.name]}"
    ours = _bag(rows, [df.columns.index(c) for c in sorted(names)])
    theirs = _bag(expected, [names.index(c) for c in sorted(names)])
    if ours != theirs:
        left, right = list((ours - theirs).elements()), list((theirs - ours).elements())
        return f"{len(rows)} / {len(expected)} rows, {len(left)} / {len(right)} differ, e.g. {left[:2]} vs {right[:2]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from fitloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    session = build_session()
    sqls = oracle_sql()
    for query_name, fn in queries().items():
        if chosen and query_name not in chosen:
            continue
        start = time.time()
        try:
            if query_name in sqls:
                found = difference(session, folder, query_name, fn, sqls[query_name]) or "ok"
            else:
                found = f"rows {len(fn(session, folder).collect())} (no SQL)"
        except Exception as error:  # a report tool: show and go on
            found = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{query_name:32} {time.time() - start:6.1f}s  {found}", flush=True)
