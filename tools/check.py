"""Run registered queries in Spark and their SQL twins in DuckDB and compare.

usage: python tools/check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from catalog import load  # noqa: E402
from catalog.base import QUERIES, TABLES, oracle  # noqa: E402
from somaloom.session import build_session  # noqa: E402


LIMIT = float(os.environ.get("CHECK_LIMIT", "60"))  # seconds per query


def _norm(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("n", float(value))
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return ("n", "nan") if math.isnan(value) else ("n", round(value, 6) + 0.0)
    if isinstance(value, (list, tuple)):
        return ("l", tuple(_norm(v) for v in value))
    if isinstance(value, dict):
        return ("m", tuple(sorted((k, _norm(v)) for k, v in value.items())))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("t", str(value))
    return ("s", str(value))


def rows_of(table) -> list:
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(_norm(v) for v in row) for row in zip(*cols)), key=repr)


def compare(spark_table, duck_table) -> list[str]:
    problems = []
    if sorted(spark_table.column_names) != sorted(duck_table.column_names):
        return [f"columns {sorted(spark_table.column_names)} != {sorted(duck_table.column_names)}"]
    for name in spark_table.column_names:
        a, b = str(spark_table.schema.field(name).type), str(duck_table.schema.field(name).type)
        if "list" not in a and a != b:
            problems.append(f"type of {name}: {a} vs {b}")
    left, right = rows_of(spark_table), rows_of(duck_table)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    if left != right:
        names = sorted(spark_table.column_names)
        in_left, in_right = set(left), set(right)
        only_left = [r for r in left if r not in in_right][:2]
        only_right = [r for r in right if r not in in_left][:2]
        problems.append(f"values differ; {names}\n   spark {only_left}\n   duck  {only_right}")
    return problems


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    load()
    ORACLE = oracle()
    names = [n for n in QUERIES if not args or any(n.startswith(a) for a in args)]
    spark = build_session("check", master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"})
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        start = time.time()
        limit = threading.Timer(LIMIT, lambda: (spark.sparkContext.cancelAllJobs(), con.interrupt()))
        limit.start()
        try:
            got = QUERIES[name](spark, sf_dir).toArrow()
            took = time.time() - start
            if name in ORACLE:
                want = con.sql(ORACLE[name]).to_arrow_table()
                problems = compare(got, want)
                state = "ok  " if not problems else "BAD "
            else:
                problems, state = [], "rows"
        except Exception as exc:  # noqa: BLE001 - report every failing query
            took, got, state, problems = time.time() - start, None, "ERR ", [f"{type(exc).__name__}: {str(exc)[:1500]}"]
        limit.cancel()
        bad += state in ("BAD ", "ERR ")
        print(f"{state} {name:32s} {took:6.2f}s +{time.time() - start - took:5.2f}s rows={got.num_rows if got is not None else '-'}", flush=True)
        if got is not None and got.num_rows == 0:
            print("     note: no rows")
        for p in problems:
            print("    ", p)
    print(f"{len(names)} queries, {bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
