"""Compare registered queries with their reference SQL: names, types, rows and values.

    python tests/oracle_check.py [--sf 0.01] [query ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    return v


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, connection, text: str) -> list[str]:
    """What differs between a Spark result and the result of the SQL, as text."""
    mine = {n: TYPES.get(t, t) for n, t in df.dtypes}
    described = connection.execute(f"describe {text}").fetchall()
    theirs = {row[0]: row[1] for row in described}
    if mine != theirs:
        return [f"schema: {sorted(set(mine.items()) ^ set(theirs.items()))}"]
    left = _bag(df.columns, df.collect())
    right = _bag(list(theirs), connection.execute(text).fetchall())
    if not left and not right:
        return ["both sides are empty"]
    if left == right:
        return []
    return [
        f"rows: {sum(left.values())} against {sum(right.values())}",
        f"only Spark: {list((left - right).elements())[:3]}",
        f"only SQL: {list((right - left).elements())[:3]}",
    ]


def main() -> int:
    import tempfile

    import __spark_entry__ as entry_points
    from monthmill.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = build_session(
        "oracle-check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="12g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="/tmp/run-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    texts, failed = entry_points.oracle_sql(), 0
    for name, query in entry_points.queries().items():
        if args.names and name not in args.names:
            continue
        started = time.time()
        try:
            found = differences(query(spark, sf_dir), connection, texts[name]) if name in texts else ["no SQL"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - started:.1f}s", *found, sep="\n     ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
