"""Run queries in Spark and DuckDB and compare rows exactly.

``python -m tests.compare [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    """Comparable form of one value; floats keep all but their last bits."""
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return (0, "") if math.isnan(f) else (2, f"{f:.12g}")
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (3, v.isoformat())
    if isinstance(v, dict):
        return (4, str({k: plain(x) for k, x in sorted(v.items())}))
    if isinstance(v, (list, tuple)):
        return (5, str([plain(x) for x in v]))
    if hasattr(v, "asDict"):
        return plain(v.asDict(recursive=True))
    return (6, str(v))


def rows_of(columns: list[str], rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def check(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    got = df.collect()
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    a, b = rows_of(df.columns, [tuple(r) for r in got]), rows_of(names, want)
    if a != b:
        diff = next(((x, y) for x, y in zip(a, b) if x != y), None)
        cols = sorted(names)
        shown = [(c, x[1], y[1]) for c, x, y in zip(cols, *diff) if x != y][:5] if diff else ""
        return False, f"rows {len(a)} vs {len(b)}; first difference {shown}"
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "int": "INTEGER", "string": "VARCHAR"}
    types = {d[0]: str(d[1]) for d in res.description}
    odd = [(c, t, types[c]) for c, t in df.dtypes if t in kinds and kinds[t] != types[c]
           and not types[c].startswith("ENUM")]
    return True, f"{len(a)} rows" + (f" types {odd}" if odd else "") + ("" if a else " EMPTY")


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from millrace.session import local

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    queries, oracle = entry.queries(), entry.oracle_sql()
    spark, con, bad = local(8), connect(sf_dir), []
    for name in wanted or queries:
        start = time.time()
        try:
            if name in oracle:
                ok, note = check(spark, con, name, queries[name], oracle[name], sf_dir)
            else:
                ok, note = True, f"{len(queries[name](spark, sf_dir).collect())} rows, no SQL"
        except Exception as e:  # report and go on to the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        if not ok:
            bad.append(name)
        if not ok or wanted or "EMPTY" in note or "types" in note or time.time() - start > 8 or "no SQL" in note:
            print("ok " if ok else "BAD", name, f"{time.time() - start:.1f}s", note, flush=True)
    print(f"{len(wanted or queries) - len(bad)} ok, {len(bad)} bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
