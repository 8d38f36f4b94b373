"""Runs registered queries next to their SQL and reports differences.

    python -m checks.compare [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as printable tuples in a fixed order, columns sorted by name."""
    def shown(value) -> str:
        if value is None or (not isinstance(value, (list, str)) and pd.isna(value)):
            return "NULL"
        if isinstance(value, float):
            return repr(value + 0.0)
        if hasattr(value, "isoformat"):
            return value.isoformat()[:10]
        if hasattr(value, "item"):
            return repr(value.item() + 0 if not isinstance(value.item(), (bool, str)) else value.item())
        return str(value)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(shown(v) for v in row) for row in frame.itertuples(index=False))


def rows_of(columns: list[str], rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns, dtype=object)


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE"}


def type_differences(connection, df, sql: str) -> dict[str, tuple]:
    """Columns whose types do not correspond: name -> (Spark type, SQL type)."""
    described = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return {
        name: (kind, described.get(name)) for name, kind in df.dtypes if SQL_TYPES.get(kind) != described.get(name)
    }


def differences(spark, connection, sf_dir: str, name: str, query, sql: str | None) -> str:
    """'' if both agree, else a short account."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if len(got) else "no rows"
    mistyped = type_differences(connection, df, sql)
    if mistyped:
        return f"types {mistyped}"
    cursor = connection.execute(sql)
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return ""
    extra, missing = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{len(a)} / {len(b)} rows; only spark {extra}; only sql {missing}"


def main(arguments: list[str]) -> int:
    from checks import all_oracles, all_queries
    from finmart import build_session

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failed = connect(sf_dir), all_oracles(), 0
    for name, query in all_queries().items():
        if arguments[1:] and not any(name.startswith(p) for p in arguments[1:]):
            continue
        started = time.time()
        try:
            problem = differences(spark, connection, sf_dir, name, query, oracles.get(name))
        except Exception as error:  # keep going: one broken query should not hide the rest
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok'} {name} [{kind}] {time.time() - started:.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
