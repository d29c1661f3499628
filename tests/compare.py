"""Run registered queries beside their SQL and report differences.

    python -m tests.compare [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import re
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

DATA = Path("/root/testdata")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _order_key(row: tuple) -> tuple:
    return tuple((value is not None, str(value)) for value in row)


def _plain(value: object) -> object:
    if isinstance(value, float) and (math.isnan(value) or value == 0.0):
        return 0.0 if value == 0.0 else "NaN"
    if isinstance(value, dict):
        return tuple(sorted(value.items()))
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _rows(table, names: list[str], ordered: bool = False) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_plain(v) for v in row) for row in zip(*columns)]
    return rows if ordered else sorted(rows, key=_order_key)


def _is_ordered(sql: str) -> bool:
    """Whether the statement as a whole, and not a part in parentheses, asks for an order."""
    while (shorter := re.sub(r"\([^()]*\)", "", sql)) != sql:
        sql = shorter
    return re.search(r"\bORDER BY\b(?!.*\bUNION\b)", sql, re.S | re.I) is not None


def _kind(arrow_type) -> str:
    return str(arrow_type).replace("large_", "").replace(", tz=UTC", "")


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement; empty when they agree."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    found = []
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} <> {sorted(theirs.column_names)}"]
    names = sorted(ours.column_names)
    for n in names:
        a, b = _kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)
        if a != b and not (a.startswith("map") or a.startswith("list") or b == "null"):
            found.append(f"type of {n}: {a} <> {b}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"{ours.num_rows} rows <> {theirs.num_rows}")
    ordered = _is_ordered(sql)
    left, right = _rows(ours, names, ordered), _rows(theirs, names, ordered)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first {names}: {wrong[0][0]} <> {wrong[0][1]}")
    return found


def main() -> int:
    import __spark_entry__ as entry_points

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    args = parser.parse_args()
    folder = str(DATA / f"sf{args.sf}")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    bad = 0
    for name in args.names or queries:
        began = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                found = differences(df, con, oracles[name])
                note = "same" if not found else "; ".join(found)
            else:
                found, note = [], f"rows {df.count()}"
        except Exception as error:  # report and go on with the next query
            found = [str(error)]
            note = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - began:.1f}s {note}", flush=True)
    print(f"{bad} bad of {len(args.names or queries)}; {len(oracles)} with SQL")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
