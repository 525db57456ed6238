"""Run registered queries and their DuckDB statements side by side.

    python tests/oracle_check.py [sf_dir] [name ...]

Prints one line per query: rows on each side and whether the sorted rows
(floats rounded to 6 places) are equal.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from vellum.session import get_spark  # noqa: E402

DUCK_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double",
              "BOOLEAN": "boolean", "FLOAT": "float"}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = df.columns
            stypes = {f.name: f.dataType.simpleString() for f in df.schema.fields}
            srows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # noqa: BLE001
            print(f"{name:24s} SPARK ERROR {str(exc)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:24s} spark={len(srows):7d}  (rows only) {ts:.1f}s")
            continue
        t0 = time.time()
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            drows = rel.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"{name:24s} DUCKDB ERROR {str(exc)[:300]}")
            bad += 1
            continue
        td = time.time() - t0
        dtypes = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(dcols, rel.types)}
        type_diff = {c: (stypes.get(c), dtypes.get(c)) for c in dtypes if stypes.get(c) != dtypes.get(c)}
        if type_diff:
            print(f"{name:24s} TYPES DIFF {type_diff}")
            bad += 1
        same_cols = sorted(cols) == sorted(dcols)
        eq = same_cols and canon(srows, cols) == canon(drows, dcols)
        if not eq:
            bad += 1
        print(f"{name:24s} spark={len(srows):7d} duck={len(drows):7d} cols={'ok' if same_cols else 'DIFF'} "
              f"{'MATCH' if eq else 'MISMATCH'} {ts:.1f}s/{td:.1f}s")
        if not eq and same_cols:
            a, b = canon(srows, cols), canon(drows, dcols)
            sa, sb = set(a), set(b)
            print("   spark-only:", [str(x)[:300] for x in list(sa - sb)[:2]])
            print("   duck-only: ", [str(x)[:300] for x in list(sb - sa)[:2]])
        elif not same_cols:
            print("   ", sorted(cols), sorted(dcols))
    print("failures:", bad)


if __name__ == "__main__":
    main()
