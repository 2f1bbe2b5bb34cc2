"""Run registered Spark queries next to their DuckDB oracle SQL and compare results.

Mimics the driver's check: row count, column names (sorted), and an
order-insensitive comparison of values (floats rounded to 6 places).

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def _kind_spark(t) -> str:
    n = t.typeName()
    if n in ("byte", "short", "integer", "long"):
        return "int"
    if n in ("float", "double", "decimal"):
        return "float"
    if n in ("timestamp", "timestamp_ntz"):
        return "timestamp"
    return n


def _kind_duck(t: str) -> str:
    t = str(t).upper()
    if t in ("TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT", "UTINYINT", "USMALLINT", "UINTEGER", "UBIGINT"):
        return "int"
    if t in ("FLOAT", "DOUBLE") or t.startswith("DECIMAL"):
        return "float"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "VARCHAR":
        return "string"
    return t.lower()


def compare_one(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    skinds = {f.name: _kind_spark(f.dataType) for f in sdf.schema.fields}
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    dkinds = {d[0]: _kind_duck(d[1]) for d in rel.description}
    drows = rel.fetchall()
    t2 = time.time()
    msg = []
    ok = True
    kinds = [f"{c}:{skinds[c]}/{dkinds.get(c)}" for c in scols if c in dkinds and skinds[c] != dkinds[c]]
    if kinds:
        msg.append("types " + ",".join(kinds))
    if sorted(scols) != sorted(dcols):
        ok = False
        msg.append(f"cols spark={sorted(scols)} duck={sorted(dcols)}")
    if len(srows) != len(drows):
        ok = False
        msg.append(f"rows spark={len(srows)} duck={len(drows)}")
    if ok:
        a, b = _rows(scols, srows), _rows(dcols, drows)
        if a != b:
            ok = False
            diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
            msg.append(f"values differ, e.g. {diffs}")
    return ok, len(srows), t1 - t0, t2 - t1, "; ".join(msg)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from __spark_entry__ import oracle_sql, queries
    from stratum.session import build_session

    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    names = names or list(qs)
    bad = 0
    for n in names:
        if n not in sqls:
            t0 = time.time()
            rows = qs[n](spark, sf_dir).count()
            print(f"ROWS  {n:28s} rows={rows} spark={time.time() - t0:.1f}s (no oracle)", flush=True)
            continue
        try:
            ok, rows, ts, td, msg = compare_one(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # report and continue
            ok, rows, ts, td, msg = False, -1, 0, 0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {n:28s} rows={rows} spark={ts:.1f}s duck={td:.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
