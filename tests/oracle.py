"""Compare a registered query with its SQL, row by row and whatever the order."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _table(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark, con, build, sql: str, folder: str) -> list[str]:
    df = build(spark, folder)
    got = df.collect()
    result = con.execute(sql)
    wanted_columns = [d[0] for d in result.description]
    wanted = result.fetchall()
    out = []
    if sorted(df.columns) != sorted(wanted_columns):
        return [f"columns {sorted(df.columns)} / {sorted(wanted_columns)}"]
    if len(got) != len(wanted):
        out.append(f"rows {len(got)} / {len(wanted)}")
    a, b = _table(df.columns, got), _table(wanted_columns, wanted)
    if a != b:
        only_a, only_b = a - b, b - a
        out.append(f"{sum(only_a.values())} only in Spark, e.g. {sorted(only_a, key=repr)[:3]}")
        out.append(f"{sum(only_b.values())} only in SQL, e.g. {sorted(only_b, key=repr)[:3]}")
        kinds = [{type(r[i]).__name__ for r in t} for t in (a, b) for i in range(len(df.columns))]
        out.append(str(kinds))
    return out


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from prosewell.session import local_session

    folder = "/root/testdata/sf0.01"
    wanted = sys.argv[1:]
    spark = local_session("oracle", memory="16g")
    con = duck(folder)
    oracles = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                found = differences(spark, con, build, oracles[name], folder)
            else:
                found = [] if build(spark, folder).count() > 0 else ["no rows"]
        except Exception as e:  # report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:1500]}"]
        took = time.time() - start
        print(f"{'FAIL' if found else 'ok  '} {name} {took:.1f}s {'' if name in oracles else '(rows only)'}", flush=True)
        for line in found:
            print("     ", line[:1500])
        bad += bool(found)
    print("failed:", bad)
