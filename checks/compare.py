"""Run registered queries beside their oracle SQL: ``python -m checks.compare [dir] [names]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import oracle_sql
from checks.queries import queries


def session(cpus: str = "8", memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        # Small inputs: keep stages parallel, and build plans without call-site tracking.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6f}"
    return None if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return [columns[n] for n in order], sorted(
        (tuple(_plain(row[n]) for n in order) for row in rows), key=lambda r: tuple(str(v) for v in r)
    )


def compare(spark, con, name, plan, text, sf_dir):
    df = plan(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(text)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} but oracle has {want[0]}"
    if got[1] != want[1]:
        missing = [r for r in want[1] if r not in set(got[1])][:3]
        surplus = [r for r in got[1] if r not in set(want[1])][:3]
        return f"{len(got[1])} rows, oracle {len(want[1])}\n  only oracle {missing}\n  only spark {surplus}"
    return None if got[1] else "no rows on either side"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con, texts, failed = session(), connect(sf_dir), oracle_sql(), 0
    for name, plan in queries().items():
        if names and name not in names:
            continue
        began = time.time()
        problem = compare(spark, con, name, plan, texts[name], sf_dir)
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
