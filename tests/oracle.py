"""Run registered queries next to their SQL in DuckDB and compare the rows.

``python tests/oracle.py [scale] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value if value is None else str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return normal(df.columns, df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return normal(columns, result.fetchall())


def compare(spark, con, query, sql, sf_dir):
    """None if equal, else a short account of the difference."""
    got_columns, got = spark_rows(query(spark, sf_dir))
    want_columns, want = duck_rows(con, sql)
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        missing = [r for r in want if r not in set(got)][:3]
        extra = [r for r in got if r not in set(want)][:3]
        return f"{len(got)} rows != {len(want)}; missing {missing}; extra {extra}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"{TESTDATA}/sf{scale}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, query, oracles[name], sf_dir) or "ok"
            else:
                verdict = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as error:
            verdict = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:24s} {time.time() - start:6.2f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
