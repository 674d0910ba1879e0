"""Runs a registered query and its SQL twin and compares all rows."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, int) and not isinstance(value, bool):
        return float(f"{value:.9g}") if abs(value) < 1 << 53 and value == float(value) and abs(value) < 10**9 else value
    return value


def _sorted(rows):
    return sorted((tuple(_plain(x) for x in r) for r in rows), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, con, name, run, sql, sf):
    """Empty text when both sides agree, else what differs."""
    df = run(spark, sf)
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    ours = [tuple(r[i] for i in order) for r in df.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs_order = sorted(range(len(names)), key=lambda i: names[i])
    theirs = [tuple(r[i] for i in theirs_order) for r in cursor.fetchall()]
    columns = [df.columns[i] for i in order]
    if columns != [names[i] for i in theirs_order]:
        return f"columns {columns} against {[names[i] for i in theirs_order]}"
    if not ours:
        return "no rows"
    a, b = _sorted(ours), _sorted(theirs)
    if a == b:
        return ""
    wrong = [(x, y) for x, y in zip(a, b) if x != y][:2]
    return f"rows {len(a)} against {len(b)}; {columns}; first differences {wrong}"
