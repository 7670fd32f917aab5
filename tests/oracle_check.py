"""Compare registered queries with their SQL: python tests/oracle_check.py [SF_DIR] [NAME_PREFIX ...]."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _cell(value):
    """Comparable form; doubles only differing in their last digits are equal."""
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def _sort_key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_cell(v) for v in r) for r in df.select([f"`{n}`" for n in names]).collect()), key=_sort_key)


def rows_of_sql(con, sql):
    rel = con.sql(sql)
    names = sorted(rel.columns)
    at = [rel.columns.index(n) for n in names]
    return names, sorted((tuple(_cell(r[i]) for i in at) for r in rel.fetchall()), key=_sort_key)


def difference(spark_side, sql_side) -> str | None:
    """First difference in words, or None when both sides are equal."""
    (n1, r1), (n2, r2) = spark_side, sql_side
    if n1 != n2:
        return f"columns {n1} / {n2}"
    if len(r1) != len(r2):
        return f"rows {len(r1)} / {len(r2)}"
    for a, b in zip(r1, r2):
        for name, x, y in zip(n1, a, b):
            if type(x) is not type(y):
                return f"{name}: {x!r} / {y!r}"
            if x != y and not (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1.1e-5)):
                return f"{name}: {x!r} / {y!r} in {a} / {b}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:]) or ("",)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    oracles = entry.oracle_sql()
    wrong = 0
    for name, fn in entry.queries().items():
        if not name.startswith(prefixes):
            continue
        began = time.time()
        try:
            found = rows_of_spark(fn(spark, folder))
            took = time.time() - began
            said = "rows only" if name not in oracles else difference(found, rows_of_sql(con, oracles[name])) or "equal"
        except Exception as error:  # report and go on with the next query
            took, said, found = time.time() - began, f"{type(error).__name__}: {str(error)[:600]}", ((), ())
        wrong += said not in ("equal", "rows only")
        print(f"{name:28s} {len(found[1]):7d} rows {took:6.2f} s  {said}", flush=True)
    print("wrong:", wrong)


if __name__ == "__main__":
    main()
