"""Compare queries with their SQL in DuckDB; also a script: compare.py SF_DIR [name ...]."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder, name, query, sql):
    """None when equal, else a text that says what differs."""
    df = query(spark, folder)
    got = df.collect()
    mine = rows_of(df.columns, got)
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = rows_of(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    types = {d[0]: str(d[1]) for d in cur.description}
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0][0]} != {wrong[0][1]}"
    kinds = dict(df.dtypes)
    plain = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP"}
    odd = {c: (kinds[c], types[c]) for c in df.columns if plain.get(kinds[c], "?") != types[c]}
    return f"types {odd}" if odd else None


def main():
    from __spark_entry__ import oracle_sql, queries
    from kilowise.plans.storage import clean_up
    from kilowise.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(folder), oracle_sql(), 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                result = compare(spark, con, folder, name, query, sqls[name]) or "ok"
            else:
                result = f"no sql, {query(spark, folder).count()} rows"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += not (result == "ok" or result.startswith("no sql"))
        print(f"{name:34} {time.time() - start:6.2f}s {result}", flush=True)
    print("failed:", bad)
    clean_up(spark)


if __name__ == "__main__":
    main()
