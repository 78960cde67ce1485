"""Run queries on Spark and their SQL on DuckDB and compare the row sets."""

from __future__ import annotations

import decimal
import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def open_duckdb(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None or v != v:
        return ""
    if isinstance(v, decimal.Decimal):
        return format(v, "f")
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v)


def row_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None if equal, else a short description."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    theirs = row_set(names, found.fetchall())
    ours = row_set(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if ours == theirs:
        return None
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, e.g. {bad[0]}"


def main(sf: str, only: list[str]) -> int:
    import __spark_entry__ as entry
    from claimweave.session import build_session

    spark = build_session("local[8]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions="8", spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = open_duckdb(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(sqls)), "unknown:",
          sorted(set(sqls) - set(queries)))
    failed = []
    for name, make in queries.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            df = make(spark, sf_dir)
            if name not in sqls:
                problem = None if df.count() > 0 else "no rows"
            else:
                problem = compare(df, con, sqls[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
