"""Compare registered queries with their SQL on DuckDB.

python tests/oracle.py [folder] [name prefix ...]
"""

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def database(folder):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return db


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, db, folder, run, sql):
    """(equal, message) for one query."""
    df = run(spark, folder)
    got_columns, got = rows_of(df.columns, df.collect())
    if sql is None:
        return got.total() > 0, f"{got.total()} rows, no SQL"
    result = db.execute(sql)
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    extra, missing = got - want, want - got
    if extra or missing:
        return False, (f"{got.total()} vs {want.total()} rows, {extra.total()} extra {list(extra)[:2]}, "
                       f"{missing.total()} missing {list(missing)[:2]}")
    return True, f"{got.total()} rows"


def main():
    from meterlake.plans.catalog import load_all
    from meterlake.plans.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    db = database(folder)
    bad = []
    for name, entry in load_all().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            ok, message = compare(spark, db, folder, entry.run, entry.sql)
        except Exception as error:  # report and go on
            ok, message = False, f"{type(error).__name__}: {str(error)[:600]}"
        print("ok  " if ok else "FAIL", name, f"{time.time() - start:.1f}s", message, flush=True)
        if not ok:
            bad.append(name)
    print(len(bad), "failed", bad)


if __name__ == "__main__":
    main()
