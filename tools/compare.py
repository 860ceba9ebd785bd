"""Run registered queries next to their SQL in DuckDB and report differences.

usage: python tools/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from engrama.plans.catalog import REGISTRY  # noqa: E402
from engrama.plans.views import BASE_TABLES  # noqa: E402
from engrama.session import build_session  # noqa: E402


def canonical(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name):
    registered = REGISTRY[name]
    start = time.time()
    frame = registered(spark, sf_dir)
    got = frame.collect()
    spent = time.time() - start
    if registered.sql is None:
        return "rows", len(got), spent, 0.0, ""
    start = time.time()
    cursor = con.execute(registered.sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    want = cursor.fetchall()
    sql_spent = time.time() - start
    if sorted(names) != sorted(frame.columns):
        return "COLUMNS", len(got), spent, sql_spent, f"{sorted(frame.columns)} vs {sorted(names)}"
    kinds = dict(zip(names, types))
    bad_types = [
        f"{c}:{s}/{kinds[c]}" for c, s in frame.dtypes
        if not any(kinds[c].upper().startswith(d) for d in {
            "bigint": ["BIGINT"], "int": ["INTEGER"], "double": ["DOUBLE"], "string": ["VARCHAR"],
            "boolean": ["BOOLEAN"], "timestamp_ntz": ["TIMESTAMP"], "date": ["DATE"],
        }.get(s, ["?"]))
    ]
    a, b = rows_of(frame.columns, got), rows_of(names, want)
    note = f" types {bad_types}" if bad_types else ""
    if a == b:
        return "ok", len(got), spent, sql_spent, note
    only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
    return "DIFF", len(got), spent, sql_spent, f"{sum((a-b).values())} only spark {only_a}\n   {sum((b-a).values())} only sql ({len(want)}) {only_b}{note}"


def main():
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = build_session("local[8]", 8, **{"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            status, n, spent, sql_spent, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on to the next query
            status, n, spent, sql_spent, note = "ERROR", 0, 0, 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += status not in ("ok", "rows")
        print(f"{status:8} {name:28} rows={n:<7} spark={spent:6.2f}s sql={sql_spent:6.2f}s {note}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
