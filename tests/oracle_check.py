"""Run registered queries against their SQL and report the first difference of each.

    python tests/oracle_check.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from oreline.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def norm(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, float) and value == int(value):
        return repr(float(value))
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(norm(row[i]) for i in order) for row in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty when both sides agree, otherwise what differs first."""
    df = entry.queries()[name](spark, sf_dir)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    wanted_names, wanted = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if names != wanted_names:
        return f"columns {names} are not {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows are not {len(wanted)}"
    wrong = [(g, w) for g, w in zip(got, wanted) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]} in {names}" if wrong else ""


def main() -> int:
    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle-check", "local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in only or entry.queries():
        start = time.time()
        try:
            said = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on to the next query
            said = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(said)
        print(f"{time.time() - start:6.2f}s {name}: {said or 'equal'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
