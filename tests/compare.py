"""Compare catalog queries with their SQL on the test tables."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

DATA = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def table(rows, names):
    """Rows with columns in order of their names, in a fixed order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


KINDS = {
    "bigint": "BIGINT", "boolean": "BOOLEAN", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "float": "FLOAT",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None if the query and its SQL agree in names, types and rows."""
    df = queries()[name](spark, sf_dir)
    got = table([tuple(r) for r in df.collect()], df.columns)
    if name not in oracle_sql():
        return None if got else "no rows"
    relation = con.sql(oracle_sql()[name])
    want = table(relation.fetchall(), relation.columns)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} and {sorted(relation.columns)}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    for column, kind in df.dtypes:
        if KINDS.get(kind, kind) != types[column]:
            return f"type of {column}: {kind} and {types[column]}"
    if got != want:
        unlike = [(a, b) for a, b in zip(got, want) if a != b]
        return f"{len(got)} and {len(want)} rows, {len(unlike)} differ, first {unlike[:1]}"
    return None


if __name__ == "__main__":
    from setwise.session import session

    spark = session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(DATA)
    chosen = sys.argv[1:] or list(queries())
    bad = 0
    for name in chosen:
        started = time.time()
        try:
            problem = difference(spark, con, name, DATA)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree; without SQL: {sorted(set(queries()) - set(oracle_sql()))}")
    sys.exit(bad > 0)
