"""Compare a Spark result with DuckDB's, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def spark_rows(df) -> tuple[list[str], list[str], Counter]:
    names = sorted(df.columns)
    kinds = [df.schema[n].dataType.simpleString() for n in names]
    rows = Counter(tuple(_value(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    return names, kinds, rows


KINDS = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
}


def duck_rows(con, sql: str) -> tuple[list[str], list[str], Counter]:
    cur = con.execute(sql)
    described = [(d[0], str(d[1])) for d in cur.description]
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    rows = Counter(tuple(_value(row[i]) for i in order) for row in cur.fetchall())
    return [described[i][0] for i in order], [KINDS.get(described[i][1], described[i][1]) for i in order], rows
