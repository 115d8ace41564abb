"""Run catalogue queries next to their SQL and compare: names, row count, values, regardless of order.

``python tests/compare.py [sf] [name...]``
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        v = v.item()
    if type(v).__name__ == "Decimal":
        v = float(v)
    if isinstance(v, float):
        return v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def as_rows(columns, rows):
    place = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(row[i]) for i in place) for row in rows]
    return [columns[i] for i in place], sorted(out, key=repr)


def difference(df, con, sql):
    """None when equal, else a text."""
    rel = con.sql(sql)
    sc, srows = as_rows(df.columns, [tuple(x) for x in df.collect()])
    dc, drows = as_rows(rel.columns, rel.fetchall())
    if sc != dc:
        return f"columns {sc} != {dc}"
    if len(srows) != len(drows):
        return f"rows {len(srows)} != {len(drows)}"
    for a, b in zip(srows, drows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b} (in {sc})"
    return None


def main():
    from phenoloom.session import local_session

    import __spark_entry__ as E

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        t = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracle:
                msg = difference(df, con, oracle[name]) or "equal"
            else:
                msg = f"rows only: {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        if msg != "equal" and not msg.startswith("rows only"):
            bad += 1
        print(f"{name:28s} {time.time() - t:6.1f}s  {msg}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
