"""Small tables and brute-force twins for the operators' tests."""

from __future__ import annotations


def documents(spark, rows, extra: bool = False):
    """Rows (doc_id, text) as documents; extra adds columns whose names operators use inside."""
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        df = df.selectExpr("*", "1 AS bucket", "'x' AS shard", "2L AS component_id", "3 AS key", "'y' AS line", "map('a', 1) AS tags")
    return df


def smallest_reachable(nodes, linked):
    """{node: smallest node reachable} over all pairs for which linked(a, b)."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
