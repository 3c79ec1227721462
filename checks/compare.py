"""Run queries and their SQL side by side: ``python -m checks.compare [sf dir] [query ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "hugeint": "int",
    "double": "float", "float": "float", "string": "text", "varchar": "text", "date": "date", "boolean": "bool",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf}/*.parquet")):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{files}'")
    return con


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf: str) -> str:
    """What is different, blank if nothing: column names, kinds of type, rows as an unordered bag."""
    df = QUERIES[name](spark, sf)
    relation = con.execute(ORACLE[name])
    theirs = {d[0]: i for i, d in enumerate(relation.description)}
    names = sorted(df.columns)
    if names != sorted(theirs):
        return f"columns {names} against {sorted(theirs)}"
    their_kinds = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1])) for d in relation.description}
    my_kinds = {n: KINDS.get(t, t) for n, t in df.dtypes}
    if any(my_kinds[n] != their_kinds[n] for n in names if their_kinds[n] in KINDS.values()):
        return f"types {my_kinds} against {their_kinds}"
    want = sorted((tuple(row[theirs[n]] for n in names) for row in relation.fetchall()), key=repr)
    got = sorted((tuple(row[n] for n in names) for row in df.collect()), key=repr)
    if len(want) != len(got):
        return f"{len(got)} rows against {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main(sf: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name in names or QUERIES:
        start = time.time()
        wrong = difference(spark, con, name, sf)
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {name} {time.time() - start:.1f}s {wrong}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
