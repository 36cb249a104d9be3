"""Compare registered Spark queries with their DuckDB twins (the correctness gate, locally).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from segmint.sources.tables import TABLES  # noqa: E402


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
        if v == 0:
            return 0.0
        return v
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def rows_of(records, cols):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c]) for c in cols))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if not isinstance(x, type(None)) else 0) for x in t))


def compare(spark_df, con, sql):
    s_cols = sorted(spark_df.columns)
    s_rows = [r.asDict() for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols_raw = [d[0] for d in res.description]
    d_rows = [dict(zip(d_cols_raw, r)) for r in res.fetchall()]
    d_cols = sorted(d_cols_raw)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} sql={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count: spark={len(s_rows)} sql={len(d_rows)}"
    a = rows_of(s_rows, s_cols)
    b = rows_of(d_rows, d_cols)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} sql={bad[0][1]}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from segmint.session import ensure_checkpoint_dir, local_session

    import os

    if os.environ.get("PLAIN_SESSION"):
        # as the driver does: a bare builder, default configs, no checkpoint folder
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8)
        ensure_checkpoint_dir(spark, fallback_local=True)
    con = duck(sf_dir)
    qs = entry.queries()
    sql = entry.oracle_sql()
    failed = []
    for name in names or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sql:
                ok, msg = compare(df, con, sql[name])
            else:
                n = df.count()
                ok, msg = True, f"rows-only: {n} rows, columns {df.columns}"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        print(f"{'OK  ' if ok else 'FAIL'} {name:24s} {time.time() - t:6.2f}s {msg}", flush=True)
        if not ok:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
