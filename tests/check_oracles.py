"""Compares every registered query with its SQL oracle: python tests/check_oracles.py SF_DIR [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value


def oracle_rows(folder: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    return names, cursor.fetchall()


def compare(spark, folder: str, name: str) -> tuple[bool, str]:
    df = queries()[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{len(rows)} rows, no oracle"
    columns, expected = oracle_rows(folder, sql)
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    order = sorted(columns)
    left = sorted((tuple(normal(r[df.columns.index(c)]) for c in order) for r in rows), key=repr)
    right = sorted((tuple(normal(r[columns.index(c)]) for c in order) for r in expected), key=repr)
    if left == right:
        kinds = {c: {type(r[order.index(c)]).__name__ for r in side} - {"NoneType"} for side in (left,) for c in order}
        other = {c: {type(r[order.index(c)]).__name__ for r in right} - {"NoneType"} for c in order}
        wrong = {c: (kinds[c], other[c]) for c in order if kinds[c] != other[c]}
        return not wrong, f"{len(left)} rows {wrong or ''}"
    here, there = set(left) - set(right), set(right) - set(left)
    return False, f"{len(left)} against {len(right)} rows; ours {sorted(here, key=repr)[:3]} oracle {sorted(there, key=repr)[:3]}"


if __name__ == "__main__":
    from ordermill.session import build_session

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    failed = []
    for name in chosen or queries():
        start = time.time()
        try:
            ok, note = compare(spark, folder, name)
        except Exception as error:  # report every query, then fail
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {note}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    sys.exit(bool(failed))
