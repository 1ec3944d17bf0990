"""Run registered queries on Spark and DuckDB and compare whole results."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

KINDS = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return ("f", float(f"{value:.12g}"))
    if isinstance(value, int):
        return ("i", value)
    return value


def differences(spark_df, con, sql: str) -> str | None:
    """None where both sides agree in column names, kinds and the bag of rows."""
    names = sorted(spark_df.columns)
    mine = Counter(tuple(_cell(r[n]) for n in names) for r in spark_df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} / {sorted(columns)}"
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    if kinds != dict(spark_df.dtypes):
        return f"kinds {dict(spark_df.dtypes)} / {kinds}"
    order = [columns.index(n) for n in names]
    theirs = Counter(tuple(_cell(r[i]) for i in order) for r in result.fetchall())
    if mine == theirs:
        return None if mine else "both empty"
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"rows {sum(mine.values())} / {sum(theirs.values())}; "
        f"only spark {list(only_mine.items())[:2]}; only duckdb {list(only_theirs.items())[:2]}"
    )
