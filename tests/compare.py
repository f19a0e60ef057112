"""Compare registered queries with their SQL counterparts value by value.

Run as a script: python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return db


def value(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, bytearray):
        return bytes(v)
    if isinstance(v, list):
        return tuple(value(x) for x in v)
    return v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(value(r[i]) for i in order) for r in rows)


def check(spark, db, folder, name, query, sql) -> tuple[bool, str]:
    frame = query(spark, folder)
    mine = table(frame.columns, frame.collect())
    result = db.sql(sql)
    theirs = table(result.columns, result.fetchall())
    if mine[0] != theirs[0]:
        return False, f"columns {mine[0]} / {theirs[0]}"
    if mine[1] == theirs[1]:
        kinds = {type(v).__name__ for r in list(mine[1])[:50] for v in r}
        other = {type(v).__name__ for r in list(theirs[1])[:50] for v in r}
        return True, f"{sum(mine[1].values())} rows" + (f" types {kinds ^ other}" if kinds ^ other else "")
    left = list((mine[1] - theirs[1]).elements())
    right = list((theirs[1] - mine[1]).elements())
    return False, (
        f"{sum(mine[1].values())}/{sum(theirs[1].values())} rows, {len(left)}/{len(right)} differ\n"
        f"  {mine[0]}\n  spark {sorted(left, key=str)[:2]}\n  sql   {sorted(right, key=str)[:2]}"
    )


def main() -> int:
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(folder), 0
    for name in names:
        start = time.time()
        try:
            good, note = check(
                spark, db, folder, name, entry.queries()[name], entry.oracle_sql()[name]
            )
        except Exception as error:  # keep going, report all
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not good
        print(f"{'ok  ' if good else 'FAIL'} {name} {time.time() - start:.2f}s {note[:1500]}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
