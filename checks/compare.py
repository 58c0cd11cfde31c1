"""Run a query on Spark and its SQL on DuckDB over the same parquet files and compare the values."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "asDict"):
        return str({k: _cell(x) for k, x in v.asDict().items()})
    if isinstance(v, dict):
        return str({k: _cell(x) for k, x in v.items()})
    if isinstance(v, (list, tuple)):
        return str([_cell(x) for x in v])
    return str(v)


def compare(spark, con, run, sql: str | None, sf_dir: str) -> dict:
    t = time.time()
    df = run(spark, sf_dir)
    cols = sorted(df.columns)
    left = sorted(tuple(_cell(r[c]) for c in cols) for r in df.collect())
    out = {"rows": len(left), "sec": round(time.time() - t, 2), "types": dict(df.dtypes)}
    if sql is None:
        return {**out, "ok": len(left) > 0, "checked": "rows"}
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    out["sql_types"] = {d[0]: str(d[1]) for d in cur.description}
    right = [dict(zip(names, r)) for r in cur.fetchall()]
    right = sorted(tuple(_cell(r.get(c)) for c in cols) for r in right)
    same_types = all(TYPES.get(t, t) == out["sql_types"].get(c) for c, t in out["types"].items())
    out["ok"] = cols == sorted(names) and left == right and same_types
    out["checked"] = "sql"
    if not out["ok"]:
        out["sql_rows"] = len(right)
        out["columns"] = (cols, sorted(names))
        out["only_spark"] = [x for x in left if x not in set(right)][:3]
        out["only_sql"] = [x for x in right if x not in set(left)][:3]
    return out
