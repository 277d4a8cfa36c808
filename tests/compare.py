"""Run registered queries beside their SQL and compare every value.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__


def duckdb_over(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return con


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(row[i] for i in order) for row in rows]
    return sorted(ordered, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(spark, con, name: str, folder: str) -> list[str]:
    found = __spark_entry__.queries()[name](spark, folder)
    result = con.execute(__spark_entry__.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    wanted = _rows(columns, result.fetchall())
    got = _rows(found.columns, [tuple(row) for row in found.collect()])
    problems = []
    if sorted(columns) != sorted(found.columns):
        problems.append(f"columns {sorted(found.columns)} instead of {sorted(columns)}")
    if len(got) != len(wanted):
        problems.append(f"{len(got)} rows instead of {len(wanted)}")
    problems += [f"{g} instead of {w}" for g, w in zip(got, wanted) if g != w][:3]
    kinds = [{type(v) for v in column if v is not None} for column in zip(*got)]
    wanted_kinds = [{type(v) for v in column if v is not None} for column in zip(*wanted)]
    if kinds != wanted_kinds:
        problems.append(f"types {kinds} instead of {wanted_kinds}")
    return problems


if __name__ == "__main__":
    from tests.conftest import local_session

    session = local_session()
    where, names = sys.argv[1], sys.argv[2:] or list(__spark_entry__.queries())
    connection = duckdb_over(where)
    failed = 0
    for query in names:
        start = time.time()
        try:
            issues = differences(session, connection, query, where)
        except Exception as error:  # noqa: BLE001
            issues = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(issues)
        print(f"{query:36s} {time.time() - start:6.1f}s {'ok' if not issues else issues}", flush=True)
    print(f"{len(names)} queries, {failed} differ")
