"""Run queries on Spark and their SQL on DuckDB and compare: columns, row count, values.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time() else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(folder: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def differences(spark, connection, folder: str, name: str) -> tuple[list[str], int]:
    """What differs (nothing when the results agree exactly) and the row count."""
    from .oracle import ORACLE
    from .queries import QUERIES

    df = QUERIES[name](spark, folder)
    ours = df.collect()
    cursor = connection.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    theirs = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"], len(ours)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows / {len(theirs)} rows")
    spark_kinds = dict(df.dtypes)
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}
    for column in names:
        if same.get(spark_kinds[column]) != kinds[column]:
            found.append(f"type of {column}: {spark_kinds[column]} / {kinds[column]}")
    left, right = _bag(df.columns, ours), _bag(names, theirs)
    if left != right:
        found.append(f"only Spark {list((left - right).items())[:2]}, only DuckDB {list((right - left).items())[:2]}")
    return found, len(ours)


def main(folder: str, *names: str) -> int:
    from mostrador.session import session

    from .oracle import ORACLE
    from .queries import QUERIES

    spark = session("compare", "local[8]", spark_sql_shuffle_partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name in names or QUERIES:
        if name not in ORACLE:
            print(f"     {name}: no SQL")
            continue
        start = time.perf_counter()
        try:
            found, rows = differences(spark, connection, folder, name)
        except Exception as error:  # keep going: the other queries are still worth comparing
            found, rows = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name}: {rows} rows, {time.perf_counter() - start:.2f} s", *found, flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
