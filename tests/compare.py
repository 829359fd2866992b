"""Run registered queries against their SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _kind(dtype: str) -> str:
    return dtype.upper().split("(")[0]


_SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "date": "DATE", "float": "FLOAT",
    "array<bigint>": "BIGINT[]",
}


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, (list, tuple)) or hasattr(value, "tolist") and not hasattr(value, "isoformat"):
        value = value.tolist() if hasattr(value, "tolist") else value
        return tuple(_plain(v) for v in value) if isinstance(value, (list, tuple)) else value
    return value


def _rows(rows, order) -> list:
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {r[0]: r[1] for r in described}
    have_types = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if want_types != have_types:
        diff = {k: (have_types.get(k), want_types.get(k)) for k in want_types.keys() | have_types.keys()}
        return f"schema: {({k: v for k, v in diff.items() if v[0] != v[1]})}"
    names = sorted(df.columns)
    have = _rows(df.collect(), [df.columns.index(n) for n in names])
    duck_names = [r[0] for r in described]
    want = _rows(con.execute(sql).fetchall(), [duck_names.index(n) for n in names])
    if len(have) != len(want):
        return f"rows: {len(have)} instead of {len(want)}"
    wrong = [(h, w) for h, w in zip(have, want) if h != w]
    return f"{len(wrong)} rows differ, first {names}: {wrong[0]}" if wrong else None


def main() -> int:
    import __spark_entry__ as entry
    from tests.session import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_session(), duck(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"no SQL ({df.count()} rows)"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or queries)} queries differ; without query: {sorted(set(sqls) - set(queries))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
