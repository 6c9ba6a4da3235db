"""Run registered queries next to their SQL in DuckDB and compare the results."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or isinstance(value, (bool, str, int)):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if type(value).__name__ == "Decimal":
        return float(f"{float(value):.12g}")
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return str(value)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = normalise(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = normalise([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        only = [r for r in got if r not in set(want)][:2] if len(got) < 5000 else []
        return f"rows {len(got)} != {len(want)} {only}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} != {b}"
    if not got:
        return "no rows on both sides"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from garimpo.session import build_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    if os.environ.get("PLAIN"):
        from pyspark.sql import SparkSession

        plain = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        spark = plain.config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", os.environ["PLAIN"]).getOrCreate()
    else:
        shared = os.environ.get("SHARED_DIR") or tempfile.mkdtemp(prefix="garimpo-oracle-")
        spark = build_session(master="local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.checkpoint.dir": "file:" + shared})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(folder), entry.oracle_sql(), 0
    names = sys.argv[1:]
    for name, run in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            error = compare(df, con, sqls[name]) if name in sqls else (None if df.count() else "no rows")
        except Exception as e:  # noqa: BLE001
            error = f"{type(e).__name__}: {str(e)[:600]}"
        bad += error is not None
        print(f"{'ok  ' if error is None else 'FAIL'} {time.time() - start:6.2f}s {name} {error or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
