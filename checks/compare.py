"""Run queries and their SQL side by side.

    python -m checks.compare [sf_dir] [query ...]
"""

import datetime
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

DEFAULT_DIR = "/root/testdata/sf0.01"


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def _plain(value):
    """A value in a form that both engines share."""
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _table(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=lambda r: [(v is None, str(v)) for v in r])


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = QUERIES[name](spark, sf_dir)
    got = _table(df.columns, df.collect())
    cursor = con.execute(ORACLE[name])
    want = _table([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} against {want[0]}"
    found = {c: TYPES.get(t, t) for c, t in df.dtypes}
    wanted = {d[0]: str(d[1]) for d in cursor.description}
    if found != wanted:
        return f"types {sorted(set(found.items()) ^ set(wanted.items()))}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows against {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first row that differs:\n  {a}\n  {b}"
    if not got[1]:
        return "no rows at all, so nothing is checked"
    return None


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else DEFAULT_DIR
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(sf_dir), 0
    for name in args or QUERIES:
        started = time.monotonic()
        try:
            if name in ORACLE:
                problem = difference(spark, con, sf_dir, name)
            else:
                problem = None if QUERIES[name](spark, sf_dir).collect() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        verdict = "ok" if problem is None else f"DIFFERS {problem}"
        print(f"{name:32s} {time.monotonic() - started:6.2f}s  {verdict}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 1))
