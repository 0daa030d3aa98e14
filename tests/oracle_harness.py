"""Run every registered query on Spark and its oracle SQL on DuckDB; compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Prints one line per query: OK / MISMATCH / ERROR with reasons.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_con(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return f"ROWS-ONLY {name}: {len(srows)} rows ({t1 - t0:.1f}s)"
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={sorted(scols)} duck={sorted(dcols)}")
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    dtypes = {d[0]: str(d[1]) for d in res.description}
    bad_types = {c: (stypes[c], dtypes[c]) for c in stypes if c in dtypes and stypes[c] != dtypes[c]}
    if bad_types:
        problems.append(f"types {bad_types}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    if not problems:
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    status = "OK" if not problems else "MISMATCH"
    return f"{status} {name}: {len(srows)} rows ({t1 - t0:.1f}s) " + "; ".join(problems)


def main():
    import __spark_entry__ as E
    from credspark.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    only = [a for a in sys.argv[1:] if not a.startswith("/")]
    spark = get_spark("oracle-harness")
    con = duck_con(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            line = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            line = f"ERROR {name}: {type(e).__name__}: {str(e)[:400]}"
        if not (line.startswith("OK") or line.startswith("ROWS-ONLY")):
            bad += 1
        print(line, flush=True)
    print(f"done: {bad} not OK")


if __name__ == "__main__":
    main()
