"""Run registered queries against their SQL counterparts; also usable from the shell."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    return con


def _norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        number = float(value)
        return None if math.isnan(number) else round(number, 9) + 0.0
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            sorted(([_norm(r[i]) for i in order] for r in rows), key=repr))


def compare(spark, con, folder, name, queries, oracles):
    """(error or None, rows, seconds in Spark, seconds in DuckDB)."""
    start = time.time()
    df = queries[name](spark, folder)
    got = df.collect()
    spark_s = time.time() - start
    if name not in oracles:
        return (None if got else "no rows"), len(got), spark_s, None
    start = time.time()
    cursor = con.execute(oracles[name])
    want_columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    duck_s = time.time() - start
    a, b = rows_of(df.columns, got), rows_of(want_columns, want)
    error = None
    if a[0] != b[0]:
        error = f"columns {a[0]} != {b[0]}"
    elif len(a[1]) != len(b[1]):
        error = f"rows {len(a[1])} != {len(b[1])}"
    elif a[1] != b[1]:
        bad = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
        error = f"{len(bad)} rows differ, e.g. {str(bad[0])[:600]}"
    return error, len(got), spark_s, duck_s


def main(folder: str, names: list[str]) -> None:
    from lexmill.plans.oracles import ORACLES
    from lexmill.plans.registry import QUERIES
    from lexmill.session import build_session

    spark = build_session("compare", "8", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or QUERIES:
        try:
            error, n, s, d = compare(spark, con, folder, name, QUERIES, ORACLES)
        except Exception as e:
            error, n, s, d = f"{type(e).__name__}: {str(e)[:700]}", -1, 0, None
        bad += error is not None
        print(f"{'FAIL' if error else 'ok  '} {name} rows={n} spark={s:.1f}s duck={'-' if d is None else f'{d:.1f}s'}"
              + (f"\n     {error}" if error else ""), flush=True)
    print("failed:", bad, "of", len(names or QUERIES))


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
