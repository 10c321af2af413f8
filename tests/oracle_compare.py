"""Run registered queries in Spark and their oracles in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
Rows are compared as multisets after sorting columns by name, columns by
name and type; doubles after rounding to 12 significant digits (sums of
doubles differ in their last bits by order).
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = bool(__import__("os").environ.get("EXACT"))


def _norm(v):
    if isinstance(v, float) and not EXACT:
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows], [columns[i] for i in order]


#: DuckDB's names of Spark's types.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    s_norm, s_cols = rows_of(sdf.columns, s_rows)
    d_norm, d_cols2 = rows_of(d_cols, d_rows)
    types = {c: TYPES.get(t, t) for c, t in sdf.dtypes}
    other = {c: (types[c], str(t)) for c, t in zip(rel.columns, rel.types) if types.get(c) != str(t)}
    ok_cols = s_cols == d_cols2 and not other
    ok_rows = Counter(s_norm) == Counter(d_norm)
    detail = ""
    if not ok_cols:
        detail = f"cols spark-only={set(s_cols)-set(d_cols2)} duck-only={set(d_cols2)-set(s_cols)} types (spark, duck)={other}"
    elif not ok_rows:
        a, b = Counter(s_norm), Counter(d_norm)
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        detail = f"rows {len(s_rows)} vs {len(d_rows)}; cols={s_cols}\n  spark-only {only_s}\n  duck-only  {only_d}"
    return ok_cols and ok_rows, len(s_rows), len(d_rows), t1 - t0, detail


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from tripkiln.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(E.queries())
    import os

    conf = {}
    if os.environ.get("TK_TZ"):
        conf["spark.sql.session.timeZone"] = os.environ["TK_TZ"]
    if os.environ.get("TK_NOBROADCAST"):
        conf["spark.sql.autoBroadcastJoinThreshold"] = "-1"
    if os.environ.get("TK_PARTITIONS"):
        conf["spark.sql.shuffle.partitions"] = os.environ["TK_PARTITIONS"]
    spark = local_session(**conf)
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for n in names:
        if n not in os_:
            df = qs[n](spark, sf_dir)
            print(f"{n:24s} rows-only {df.count()}")
            continue
        ok, ns, nd, secs, detail = compare(spark, con, n, qs[n], os_[n], sf_dir)
        bad += not ok
        print(f"{n:24s} {'OK ' if ok else 'BAD'} spark={ns} duck={nd} {secs:.1f}s {detail}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv))
