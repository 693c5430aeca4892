"""Runs registered queries in Spark and their SQL in DuckDB, and compares names, types and rows.

Usage: python tests/oracle.py [sf folder] [query name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from registry.base import TABLES  # noqa: E402

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def compare(spark, con, sf_dir, name, build, sql):
    """Returns a list of differences, empty when all agree, and the number of rows."""
    frame = build(spark, sf_dir)
    got_names = sorted(frame.columns)
    spark_rows = [tuple(canonical(r[c]) for c in got_names) for r in frame.collect()]
    if sql is None:
        return [], len(spark_rows)
    relation = con.sql(sql)
    names = sorted(relation.columns)
    if names != got_names:
        return [f"names {got_names} <> {names}"], len(spark_rows)
    kinds = dict(zip(relation.columns, [str(t) for t in relation.types]))
    problems = [
        f"type of {c}: {k} <> {kinds[c]}" for c, k in frame.dtypes if KINDS.get(k, k) != kinds[c]
    ]
    order = [relation.columns.index(c) for c in names]
    duck_rows = [tuple(canonical(r[i]) for i in order) for r in relation.fetchall()]
    a, b = Counter(spark_rows), Counter(duck_rows)
    if a != b:
        problems.append(f"rows {len(spark_rows)} <> {len(duck_rows)}; only Spark {list((a - b).items())[:3]}; "
                        f"only SQL {list((b - a).items())[:3]}")
    return problems, len(spark_rows)


def main():
    from pyspark.sql import SparkSession

    from registry import all_oracles, all_queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed, empty = connect(sf_dir), all_oracles(), 0, []
    for name, build in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problems, rows = compare(spark, con, sf_dir, name, build, oracles.get(name))
        except Exception as error:  # report and go on with the next query
            problems, rows = [f"{type(error).__name__}: {str(error)[:1500]}"], -1
        if rows == 0:
            empty.append(name)
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={rows} {time.time() - start:.2f}s"
              f"{'' if name in oracles else ' (no SQL)'}", *problems, sep="\n     ", flush=True)
    print(f"failed: {failed}; empty: {empty}")


if __name__ == "__main__":
    main()
