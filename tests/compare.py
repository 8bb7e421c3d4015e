"""Run the queries and their SQL side by side: python -m tests.compare [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, statement: str) -> list[str]:
    """Empty if columns, row count and values agree."""
    found = con.execute(statement)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    want, got = rows_of(names, found.fetchall()), rows_of(df.columns, df.collect())
    out = []
    short = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "int": "INTEGER", "boolean": "BOOLEAN"}
    for c, t in df.dtypes:
        if short.get(t, t) != kinds[c] and not kinds[c] in ("STRING", "NUMBER"):
            out.append(f"type of {c}: {t} against {kinds[c]}")
    if len(want) != len(got):
        out.append(f"{len(got)} rows against {len(want)}")
    if want != got:
        a, b = set(got) - set(want), set(want) - set(got)
        out.append(f"{len(a)} rows differ, such as {sorted(a)[:2]} against {sorted(b)[:2]}")
    return out


def main() -> int:
    import __spark_entry__ as entry
    from basketshift.session import build_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", 8, "12g")
    spark.sparkContext.setLogLevel("OFF")
    con, statements, bad = database(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        t = time.time()
        df = query(spark, folder)
        if name in statements:
            diff = differences(df, con, statements[name])
            bad += bool(diff)
            print(f"{'BAD ' if diff else 'ok  '} {name} {time.time() - t:.1f}s {diff or ''}", flush=True)
        else:
            print(f"rows {name} {df.count()} {time.time() - t:.1f}s", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
