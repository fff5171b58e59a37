"""Compare registered queries with their SQL: python tests/oracle.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def connect(sf_dir: str):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return repr(v)
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


def compare(df, connection, sql: str | None) -> tuple[str, str]:
    """("ok" | "rows" | "FAIL", detail)"""
    mine = [tuple(r) for r in df.collect()]
    if sql is None:
        return "rows", f"{len(mine)} rows"
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    kinds = {d[0]: str(d[1]) for d in connection.execute(f"DESCRIBE {sql}").fetchall()}
    if sorted(columns) != sorted(df.columns):
        return "FAIL", f"columns {sorted(df.columns)} vs {sorted(columns)}"
    odd = {c: (t, kinds[c]) for c, t in df.dtypes if TYPES.get(t) != kinds[c]}
    if odd:
        return "FAIL", f"types {odd}"
    a, b = canonical(df.columns, mine), canonical(columns, theirs)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return "FAIL", f"{len(a)} vs {len(b)} rows\n   spark {only_a}\n   sql   {only_b}\n   {sorted(columns)}"
    return "ok", f"{len(a)} rows"


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    from panelspark.suite import ORACLES, QUERIES
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in args or QUERIES:
        start = time.time()
        try:
            state, detail = compare(QUERIES[name](spark, sf_dir), connection, ORACLES.get(name))
        except Exception as error:  # report and go on with the next query
            state, detail = "FAIL", f"{type(error).__name__}: {str(error)[:1500]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += state == "FAIL"
        print(f"{state:5} {name:32} {time.time() - start:6.2f}s {detail}", flush=True)
    print("failures:", bad, "of", len(args or QUERIES))
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
