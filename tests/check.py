"""Run registered queries and their SQL side by side and compare the rows."""

from __future__ import annotations

import sys
import tempfile
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, db, name, fn, sql, sf_dir):
    """Empty text when the query matches, else what is different."""
    df = fn(spark, sf_dir)
    got = [tuple(row) for row in df.collect()]
    if sql is None:
        return "" if got else "no rows"
    result = db.sql(sql)
    want_columns, want = result.columns, result.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    a, b = canonical(df.columns, got), canonical(want_columns, want)
    if a == b:
        return "" if a else "no rows on either side"
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{len(a)} rows != {len(b)} rows; only Spark {only_a}; only SQL {only_b}"[:1500]


def main() -> int:
    from tests.conftest import make_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark, db = make_session(tempfile.mkdtemp(prefix="check-")), database(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            problem = compare(spark, db, name, fn, sqls.get(name), sf_dir)
        except Exception as e:
            problem = "".join(traceback.format_exception_only(e))[:1500]
        kind = "sql " if name in sqls else "rows"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
