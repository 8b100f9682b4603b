"""Run registered queries and their DuckDB oracles on one scale factor and compare.

Comparison: same column names (sorted), same row count, same multiset of rows
after normalising values to text (dates, timestamps, floats rounded to 1e-9).
Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return f"{round(v, 9):.9f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _rows(cols: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


# Spark type -> DuckDB type name, for the schema check.
_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    t0 = time.time()
    df = query(spark, sf_dir)
    spark_cols = df.columns
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    spark_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    out = {"query": name, "rows": len(spark_rows), "spark_sec": round(t1 - t0, 3)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    o_cols = rel.columns
    o_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    o_rows = rel.fetchall()
    out["oracle_rows"] = len(o_rows)
    if sorted(spark_cols) != sorted(o_cols):
        out["status"] = f"columns differ: {sorted(spark_cols)} vs {sorted(o_cols)}"
        return out
    diff = {c: (spark_types[c], o_types[c]) for c in spark_cols if spark_types[c] != o_types[c]}
    if diff:
        out["type_diff"] = diff
    a, b = _rows(spark_cols, spark_rows), _rows(o_cols, o_rows)
    if a == b:
        out["status"] = "match" if not diff else "values match, types differ"
    else:
        sa, sb = set(a), set(b)
        out["status"] = "values differ"
        out["only_spark"] = [list(x) for x in list(sa - sb)[:2]]
        out["only_oracle"] = [list(x) for x in list(sb - sa)[:2]]
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    import __spark_entry__ as E
    from chatlake.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            r = compare(spark, sf_dir, name, q, sqls.get(name), con)
        except Exception as e:  # report and continue
            r = {"query": name, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    print(f"{len(qs) if not wanted else len(wanted)} queries, {bad} not matching")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
