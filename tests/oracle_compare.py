"""Compare a registered Spark query with its DuckDB SQL on the same tables.

Usage: ``python -m tests.oracle_compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def _hash(rows) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as entry
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    scols = sdf.columns
    stypes = dict(sdf.dtypes)
    res = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a, b = _rows(scols, srows), _rows(dcols, drows)
    out = {
        "name": name, "spark_rows": len(srows), "duck_rows": len(drows),
        "cols_match": sorted(scols) == sorted(dcols), "spark_cols": scols,
        "duck_cols": dcols, "hash_match": _hash(a) == _hash(b), "spark_sec": round(t_spark, 2),
        "spark_types": stypes,
    }
    if not out["hash_match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = sorted(sa - sb)[:5]
        out["only_duck"] = sorted(sb - sa)[:5]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from gridsense.session import get_session
    import __spark_entry__ as entry
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    ok = True
    for name in names or entry.queries():
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as e:  # report and go on
            print(f"{name}: ERROR {type(e).__name__}: {str(e)[:500]}")
            ok = False
            continue
        good = r["hash_match"] and r["cols_match"] and r["spark_rows"] == r["duck_rows"]
        ok &= good
        print(f"{name}: {'OK ' if good else 'BAD'} rows {r['spark_rows']}/{r['duck_rows']} "
              f"{r['spark_sec']}s", "" if good else r)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
