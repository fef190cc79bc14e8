"""Compare a Spark result with what DuckDB gives for the registered SQL."""

from collections import Counter
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


def difference(con, sql: str, df) -> str | None:
    """None if names, types and rows agree, else what does not."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(names)} and {sorted(df.columns)}"
    want_types = {d[0]: str(d[1]) for d in cur.description}
    for name, kind in df.dtypes:
        if SPARK_TYPES[kind] != want_types[name]:
            return f"type of {name}: {want_types[name]} and {kind}"
    want = rows_of(names, cur.fetchall())
    got = rows_of(df.columns, df.collect())
    if want != got:
        return f"missing {list((want - got).items())[:3]}, extra {list((got - want).items())[:3]} of {want.total()}/{got.total()}"
    return "no rows to compare" if not want else None
