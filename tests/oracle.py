"""Runs queries beside their SQL: rows, columns and values must agree. ``python tests/oracle.py [NAME...]`` reports on sf0.01."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings qa_pairs source_rows graph_visualization_output graph_json eval_items reading_labels pack_capacities common_words".split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{directory}/{t}.parquet')")
    return c


def plain(v):
    """A value in a form that compares alike for both engines."""
    if v is None or isinstance(v, bool | str):
        return v
    if isinstance(v, int | float) or type(v).__name__ == "Decimal":
        v = float(v)
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    return str(v)


def rows_of(columns: list[str], rows) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, con, name: str, query, sql: str, directory: str) -> str:
    """Empty if both agree, else what differs."""
    df = query(spark, directory)
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    theirs = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(cols)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} against {b}"
    return ""


def main(names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    d = "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, qs, sqls, bad = connect(d), e.queries(), e.oracle_sql(), 0
    for name in names or sqls:
        t = time.time()
        try:
            why = compare(spark, con, name, qs[name], sqls[name], d) if name in sqls else f"no SQL; {qs[name](spark, d).count()} rows"
        except Exception as x:  # noqa: BLE001
            why = repr(x)[:1500]
        bad += bool(why) and name in sqls
        print(f"{'ok ' if not why else 'BAD' if name in sqls else '-- '} {name} {time.time() - t:.1f}s {why[:1200]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
