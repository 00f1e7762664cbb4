"""Compare a Spark result with the checking SQL, column by column and row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, (bool, int, float)):
        return (1, f"{float(value):.6g}")
    return (2, str(value))


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(r[i] for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple(_key(v) for v in r))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(names), rows_of(names, cur.fetchall())


def difference(df, con, sql: str, exact: bool = True) -> str | None:
    """None when equal, else what differs first."""
    s_names, s = spark_rows(df)
    o_names, o = sql_rows(con, sql)
    if s_names != o_names:
        return f"columns {s_names} != {o_names}"
    if len(s) != len(o):
        return f"rows {len(s)} != {len(o)}"
    for a, b in zip(s, o):
        for name, x, y in zip(s_names, a, b):
            if x == y:
                if isinstance(x, bool) != isinstance(y, bool) or isinstance(x, float) != isinstance(y, float):
                    return f"{name}: type of {x!r} != {y!r}"
                continue
            close = isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9)
            if exact or not close:
                return f"{name}: {x!r} != {y!r}{' (close)' if close else ''}"
    return None
