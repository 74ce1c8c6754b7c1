"""Run registered queries next to their DuckDB oracle and compare results.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


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
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                  "string": "VARCHAR", "smallint": "SMALLINT", "float": "FLOAT",
                  "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, sf_dir: str, key: str, query, sql: str | None, con=None):
    t0 = time.time()
    df = query(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    snames = df.columns
    t_spark = time.time() - t0
    if sql is None:
        return {"key": key, "rows": len(srows), "oracle": None, "spark_s": round(t_spark, 2)}
    con = con or duck(sf_dir)
    t0 = time.time()
    res = con.execute(sql)
    dnames = [d[0] for d in res.description]
    dtypes = dict(zip(dnames, [str(d[1]) for d in res.description]))
    drows = res.fetchall()
    t_duck = time.time() - t0
    ok_names = sorted(snames) == sorted(dnames)
    stypes = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    type_diff = {k: (stypes[k], dtypes.get(k)) for k in stypes if stypes[k] != dtypes.get(k)}
    a, b = _rows(snames, srows), _rows(dnames, drows)
    same = ok_names and a == b
    info = {"key": key, "rows": len(srows), "oracle_rows": len(drows), "names": ok_names,
            "types": type_diff or "same",
            "match": same, "spark_s": round(t_spark, 2), "duck_s": round(t_duck, 2)}
    if not same:
        info["spark_cols"] = snames
        info["duck_cols"] = dnames
        diff = [x for x in a if x not in set(b)][:3] if ok_names else []
        info["sample_spark_only"] = diff
        info["sample_duck_only"] = [x for x in b if x not in set(a)][:3] if ok_names else []
    return info


if __name__ == "__main__":
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from quarry.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for key in keys or list(qs):
        info = compare(spark, sf_dir, key, qs[key], sqls.get(key), con)
        bad += info.get("match") is False
        print(info, flush=True)
    print("MISMATCHES", bad)
