"""Run queries next to their oracle SQL in DuckDB and compare all values.

    python -m tests.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def oracle(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def compare(spark, con, folder, name, query, sql):
    """None when equal, else a short account of the difference."""
    df = query(spark, folder)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, cur.fetchall())
    if got == want:
        return None if got else "both empty"
    extra, lacking = got - want, want - got
    return (
        f"{sum(got.values())} rows, want {sum(want.values())}; columns {sorted(names)}; "
        f"extra {list(extra.items())[:2]}; lacking {list(lacking.items())[:2]}"
    )


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from millrace.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark = build_session("compare", cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(folder)
    known, sqls = queries(), oracle_sql()
    failed = []
    for name in chosen:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, known[name], sqls.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        took = f"{time.time() - start:5.1f}s"
        print(f"{'FAIL' if problem else 'ok  '} {took} {name} {'' if name in sqls else '(no oracle) '}{problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(chosen) - len(failed)} of {len(chosen)} agree; failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
