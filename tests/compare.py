"""Compare the registered queries with their SQL in DuckDB.

As a script: ``python tests/compare.py [folder] [key ...]`` prints one line per key.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

BASE_VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_VIEWS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, list):
        return tuple(value)
    return value


def rows_of(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[str, int]:
    """An empty text if both sides are equal, and the number of rows."""
    rows = df.collect()
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}", len(rows)
    got, expected = rows_of(df.columns, rows), rows_of(names, expected_rows)
    if got == expected:
        return "", len(rows)
    return f"rows {len(rows)} / {len(expected_rows)}: " \
        f"only here {list((got - expected).items())[:3]}, only there {list((expected - got).items())[:3]}", len(rows)


def main() -> None:
    from addrspark.session import builder
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (
        builder("compare").master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    patterns, bad = sys.argv[2:], 0
    for key, query in entry.queries().items():
        if patterns and not any(key.startswith(p) for p in patterns):
            continue
        start = time.time()
        try:
            if key in sql:
                diff, count = difference(query(spark, sf_dir), con, sql[key])
            else:
                diff, count = "", len(query(spark, sf_dir).collect())
        except Exception as e:  # noqa: BLE001
            diff, count = f"{type(e).__name__}: {str(e)[:1500]}", -1
        bad += bool(diff)
        state = "DIFF" if diff else "ok" if key in sql else "rows only"
        print(f"{state:10}{key:42}{count:9}{time.time() - start:8.2f}s {diff}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
