"""Compare a Spark result with a SQL result: columns by name, rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def sql_tables(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def sql_rows(con, statement: str) -> tuple[list[str], Counter]:
    cursor = con.execute(statement)
    names = [d[0] for d in cursor.description]
    return _normal(names, cursor.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    return _normal(df.columns, [tuple(r) for r in df.collect()])


def _normal(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)
