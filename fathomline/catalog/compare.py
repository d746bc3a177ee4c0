"""Run a registered query and its SQL side by side. `python -m fathomline.catalog.compare [pattern] [folder]`."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import re
import sys
import time
import traceback

from fathomline.catalog.registry import Query

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads=4")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{os.path.join(folder, table)}.parquet')")
    return con


def plain(value: object) -> object:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimal in a result")
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        raise TypeError("date in a result")
    return value


def ordered(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def compare(query: Query, spark, con, folder: str) -> tuple[bool, str]:
    df = query(spark, folder)
    names = sorted(df.columns)
    left = ordered([tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()])
    if query.sql is None:
        return True, f"{len(left)} rows, no SQL"
    cursor = con.execute(query.sql)
    got = [d[0] for d in cursor.description]
    if sorted(got) != names:
        return False, f"columns {names} vs {sorted(got)}"
    if any(str(d[1]).upper() == "HUGEINT" for d in cursor.description):
        return False, "HUGEINT in the SQL result"
    index = [got.index(n) for n in names]
    right = ordered([tuple(r[i] for i in index) for r in cursor.fetchall()])
    if len(left) != len(right):
        return False, f"{len(left)} rows vs {len(right)}: {[r for r in left if r not in right][:2]} / {[r for r in right if r not in left][:2]}"
    for a, b in zip(left, right):
        if repr(a) != repr(b):
            return False, f"{len(left)} rows; columns {names}\n    spark {a}\n    sql   {b}"
    return True, f"{len(left)} rows"


def main() -> None:
    from fathomline.catalog import all_queries
    from fathomline.session import build_session

    pattern = sys.argv[1] if len(sys.argv) > 1 else "."
    folder = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, query in all_queries().items():
        if not re.search(pattern, name):
            continue
        began = time.time()
        try:
            ok, note = compare(query, spark, con, folder)
        except Exception as error:  # report and go on to the next query
            ok, note = False, "".join(traceback.format_exception_only(error))[:900]
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - began:.1f}s {note}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
