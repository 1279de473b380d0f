"""Compare registered queries with their SQL in DuckDB.

    python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    relation = con.sql(sql)
    return list(relation.columns), relation.fetchall()


def ordered(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted, floats to nine digits."""
    places = [columns.index(c) for c in sorted(columns)]

    def value(v: object) -> object:
        return float(f"{v:.9g}") if isinstance(v, float) else v

    shown = [tuple(value(row[i]) for i in places) for row in rows]
    return sorted(shown, key=repr)


def types(rows: list[tuple]) -> list[set[str]]:
    width = len(rows[0]) if rows else 0
    return [{type(row[i]).__name__ for row in rows if row[i] is not None} for i in range(width)]


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    left = ordered(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    columns, rows = duck_rows(con, sql)
    right = ordered(columns, rows)
    if sorted(spark_df.columns) != sorted(columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    if not left:
        return "no rows"
    if types(left) != types(right):
        return f"types {types(left)} vs {types(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from martloom.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracle = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = difference(build(spark, folder), con, oracle[name])
            else:
                problem = f"rows only: {build(spark, folder).count()}"
        except Exception as error:  # noqa: BLE001 - a broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        counted = problem is not None and problem.startswith("rows only")
        failed += problem is not None and not counted
        mark = "ok  " if problem is None else "rows" if counted else "DIFF"
        print(f"{mark} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print("failed", failed)
