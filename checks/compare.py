"""Compare every registered query with its SQL: ``python -m checks.compare [folder] [names]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracle import ORACLE
from footfall.plans.registered import QUERIES
from footfall.session import session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_normal(row[i]) for i in order) for row in rows)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if rows, columns, types and values agree, else what differs."""
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    same = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
    for column, kind in df.dtypes:
        if same.get(kind) != kinds[column]:
            return f"type of {column}: {kind} != {kinds[column]}"
    if got != want:
        missing = [r for r in want if r not in set(got)][:3]
        extra = [r for r in got if r not in set(want)][:3]
        return f"{len(got)} rows, want {len(want)}; missing {missing}; extra {extra}"
    return None if got else "no rows"


def main(folder: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = session("compare", "local[8]", 8, settings={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            problem = compare(spark, con, folder, name) if name in ORACLE else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:300]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - started:6.2f}s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
