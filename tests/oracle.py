"""Runs registered queries beside their SQL in DuckDB and compares them."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder):
    import duckdb

    connection = duckdb.connect()
    connection.execute("SET threads TO 4")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(canonical(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    found = [d[0] for d in cursor.description]
    places = sorted(range(len(found)), key=lambda i: found[i])
    rows = sorted(tuple(canonical(row[i]) for i in places) for row in cursor.fetchall())
    return sorted(found), rows


def compare(spark, folder, name, queries, sqls, connection):
    """None when equal, else a description of the first differences."""
    df = queries[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        return "the plan pairs all rows of two inputs"
    names, got = spark_rows(df)
    if name not in sqls:
        return None
    want_names, want = duck_rows(connection, sqls[name])
    if names != want_names:
        return f"columns {names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, SQL has {len(want)}; e.g. {got[:1]} {want[:1]}"
    differing = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(differing)} of {len(got)} rows differ, e.g. {differing[0]} in {names}" if differing else None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    from formline.session import build_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("HOT_ROWS"):
        spark.conf.set("formline.hotGroupRows", os.environ["HOT_ROWS"])
    queries, sqls = entry.queries(), entry.oracle_sql()
    connection = duck(folder)
    bad = 0
    for name in queries:
        if wanted and name not in wanted and not any(w.endswith("*") and name.startswith(w[:-1]) for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, folder, name, queries, sqls, connection)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        mark = "ok " if problem is None else "BAD"
        bad += problem is not None
        print(f"{mark} {name} {'' if name in sqls else '(rows only) '}{time.time() - start:.2f}s {problem or ''}", flush=True)
    print("bad:", bad)
