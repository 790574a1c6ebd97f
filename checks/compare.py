"""Run registered queries in Spark and DuckDB and compare them as multisets of rows.

``python -m checks.compare [folder] [name-prefix ...]``
"""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

import duckdb

SOURCES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in SOURCES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, dt.datetime) and v.time() == dt.time():
        return v.date()
    return float(f"{v:.9g}") if isinstance(v, float) else v


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    rel = con.sql(sql)
    return sorted(rel.columns), _rows(rel.columns, rel.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def _family(t: str) -> str:
    t = t.lower()
    return {"integer": "int", "varchar": "string", "tinyint": "tinyint", "bigint": "bigint"}.get(t, t)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and the DuckDB result; empty when they agree."""
    (sc, s), (dc, d) = spark_rows(df), duck_rows(con, sql)
    found = []
    if sc != dc:
        found.append(f"columns {sc} != {dc}")
    elif s != d:
        found.append(f"rows {sum(s.values())} vs {sum(d.values())}; only spark {list((s - d))[:2]}; "
                     f"only duckdb {list((d - s))[:2]}")
    rel = con.sql(sql)
    kinds = {n: _family(str(t)) for n, t in zip(rel.columns, rel.types)}
    for name, kind in df.dtypes:
        if kinds.get(name, kind) != _family(kind):
            found.append(f"type of {name}: {kind} vs {kinds[name]}")
    return found


def main(argv: list[str]) -> int:
    from checks import registry
    from daybook.session import session

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                    spark__ui__enabled="false", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = duck(folder), registry.oracle_sql(), 0
    for name, query in registry.queries().items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            if name in oracle:
                found = differences(query(spark, folder), con, oracle[name])
            else:
                found = [] if query(spark, folder).count() else ["no rows"]
        except Exception as e:  # report and go on
            found = [f"{type(e).__name__}: {str(e)[:1500]}"]
        bad += bool(found)
        print(f"{name:48s} {time.time() - start:6.2f}s {'ok' if not found else found}"
              f"{'' if name in oracle else ' (rows only)'}", flush=True)
    print("differences:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
