"""Run registered queries against their SQL: ``python tests/check.py FOLDER [NAME ...]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def norm(v):
        if isinstance(v, decimal.Decimal):
            return str(v)
        return v.isoformat() if isinstance(v, datetime.datetime) else v
    return sorted((tuple(norm(r[k]) for k in order) for r in rows), key=repr)


def differences(spark, con, name: str, query, sql: str, folder: str) -> str | None:
    df = query(spark, folder)
    got_rows = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    want_rows = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got_rows == want_rows:
        return None
    only_got = [r for r in got_rows if r not in set(want_rows)][:2]
    only_want = [r for r in want_rows if r not in set(got_rows)][:2]
    return f"{len(got_rows)} rows, want {len(want_rows)};\n  got  {only_got}\n  want {only_want}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from webtab.session import build_session
    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session("check", f"local[{os.environ.get('CHECK_CPUS', 8)}]", spark__sql__shuffle__partitions="8",
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            sql = oracle_sql().get(name)
            if sql is None:
                print(f"rows {name} {query(spark, folder).count()}, no SQL", flush=True)
                continue
            problem = differences(spark, con, name, query, sql, folder)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s", problem or "", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
