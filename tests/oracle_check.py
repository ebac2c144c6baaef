"""Run registered queries next to their SQL in DuckDB and compare rows.

    python tests/oracle_check.py [--sf DIR] [name part ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "long", "hugeint": "long",
    "float": "double", "double": "double", "string": "text", "varchar": "text", "boolean": "bool",
}


def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(frame, connection, statement: str) -> str:
    """Empty text if names, types and rows agree, else what differs."""
    cursor = connection.execute(statement)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: KINDS.get(str(d[1]).lower(), str(d[1]).lower()) for d in cursor.description}
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} expected {sorted(names)}"
    found_kinds = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in frame.schema.fields}
    wrong = {n: (found_kinds[n], kinds[n]) for n in names if found_kinds[n] != kinds[n]}
    found = _rows(frame.columns, (tuple(row) for row in frame.collect()))
    if found != expected:
        extra, missing = list((found - expected).items())[:2], list((expected - found).items())[:2]
        return f"rows {sum(found.values())} expected {sum(expected.values())}; columns {sorted(names)}; extra {extra}; missing {missing}"
    return f"types {wrong}" if wrong else ""


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("oracle-check")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.retainedStages", "20000")  # a test sums over all stages of the session
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    import __spark_entry__ as entry

    spark, connection = session(), duck(options.sf)
    statements, failed = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if options.names and not any(part in name for part in options.names):
            continue
        start = time.time()
        try:
            frame = query(spark, options.sf)
            if name in statements:
                problem = compare(frame, connection, statements[name])
            else:
                problem = "" if frame.count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if not problem else 'BAD'} {time.time() - start:6.2f}s {name} {problem[:1200]}", flush=True)
        if problem:
            failed.append(name)
        spark.catalog.clearCache()
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
