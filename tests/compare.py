"""Compare a registered query with its SQL counterpart in DuckDB.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return repr(value + 0.0)
    if isinstance(value, datetime.datetime | datetime.date):
        return value.isoformat()
    return repr(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def main() -> None:
    root = Path(__file__).resolve().parents[1]
    sys.path.insert(0, str(root))
    from textlake import plans
    from textlake.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = plans.oracle_sql()
    for name, query in plans.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            columns, got = spark_rows(query(spark, folder))
        except Exception as error:  # noqa: BLE001
            print(f"{name:28} FAILED {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"{name:28} rows only {sum(got.values())} {took:.1f}s", flush=True)
            continue
        start = time.time()
        try:
            wanted_columns, wanted = duck_rows(connection, oracles[name])
        except Exception as error:  # noqa: BLE001
            print(f"{name:28} SQL FAILED {str(error)[:1500]}", flush=True)
            continue
        same = columns == wanted_columns and got == wanted
        print(
            f"{name:28} {'ok' if same else 'DIFFERENT'} {sum(got.values())} {took:.1f}s "
            f"sql {time.time() - start:.1f}s",
            flush=True,
        )
        if not same:
            print("   columns", columns, wanted_columns)
            for label, extra in (("spark", got - wanted), ("sql", wanted - got)):
                for row, n in list(extra.items())[:2]:
                    print("  ", label, n, [v[:300] for v in row])
    spark.stop()


if __name__ == "__main__":
    main()
