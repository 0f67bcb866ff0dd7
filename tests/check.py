"""Compare registered queries with their SQL: python -m tests.check [--sf DIR] [names...]"""

from __future__ import annotations

import argparse
import math
import time

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as spark_entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("checks")
             .config("spark.sql.shuffle.partitions", str(cpus)).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), [columns[i] for i in order]


def compare(spark, con, name: str, sf: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = spark_entry.queries()[name](spark, sf)
    mine, cols = normalise(df.columns, [tuple(r) for r in df.collect()])
    if name not in spark_entry.oracle_sql():
        return None if mine else "no rows"
    cur = con.execute(spark_entry.oracle_sql()[name])
    theirs, other = normalise([d[0] for d in cur.description], cur.fetchall())
    if cols != other:
        return f"columns {cols} vs {other}"
    if not mine:
        return "no rows"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}: {mine[:2]} / {theirs[:2]}"
    kinds = [(type(a), type(b)) for a, b in zip(mine[0], theirs[0])]
    if any(a is not b for a, b in kinds if type(None) not in (a, b)):
        return f"types {kinds}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ: {bad[0]}" if bad else None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = session(), connect(args.sf)
    failed = []
    names = args.names or list(spark_entry.queries())
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, args.sf)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        kind = "sql " if name in spark_entry.oracle_sql() else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
