import numpy as np
import pytest
from helpers import smallest_reachable

from chronolode.llm import embeddings


def clouds(rng, n, dims, groups, noise):
    """Lone vectors, and groups of vectors around a centre."""
    lone = rng.standard_normal((n, dims))
    near = [c + noise * rng.standard_normal((k, dims)) / np.sqrt(dims) for k, c in ((k, rng.standard_normal(dims)) for k in groups)]
    out = np.concatenate([lone, *near])
    return [v.tolist() for v in out * rng.uniform(0.1, 50, (len(out), 1))]


def brute(rows):
    """(vec_id, n_links, component_id, kept) per row; ids of rows are their places."""
    good = {}
    for i, (_, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v, np.float64)
            x = x / np.abs(x).max()
            good[i] = x / np.linalg.norm(x)
    near = {(i, j) for i, u in good.items() for j, w in good.items() if i != j and len(u) == len(w) and u @ w >= 0.9}
    root = smallest_reachable(list(range(len(rows))), lambda i, j: (i, j) in near)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root[i]] = min(k, low.get(root[i], k))
    out = []
    for i, (k, _) in enumerate(rows):
        c = low.get(root[i]) if i in good else k
        out.append((k, sum(a == i for a, _ in near), c, None if k is None or c is None else k == c))
    return sorted(out, key=str)


def found(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS n", "'x' AS vec", "2 AS cid", "3 AS label")
    return sorted([tuple(r) for r in embeddings.near_vectors(df).select("vec_id", "n_links", "component_id", "kept").collect()], key=str)


@pytest.mark.parametrize("dims", [2, 16, 64])
def test_by_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 40)
    rng = np.random.default_rng(dims)
    vectors = clouds(rng, 100, dims, [30, 5, 2, 2], 0.25)
    rows = [(i + 3, np.float32(v).tolist()) for i, v in enumerate(vectors)]
    rows += [(1, rows[0][1]), (500, rows[0][1]), (501, [2 * x for x in rows[0][1]]), (None, rows[110][1]), (rows[0][0], rows[5][1])]
    rows += [(600, None), (601, []), (602, [0.0] * dims), (603, [None] + [1.0] * (dims - 1)), (604, [float("nan")] * dims), (605, [float("inf")] * dims), (606, rows[0][1] + [0.0]), (None, None)]
    assert found(spark, rows) == brute(rows)


def test_doubles_of_any_size(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1e300, -1e300]), (4, [3.0, 1.0])]
    assert found(spark, rows, "double") == brute(rows)
    assert found(spark, []) == []


def test_estimates_are_unbiased():
    """Over rotations, errors average out, and few leave a bound of two deviations."""
    rng = np.random.default_rng(4)
    unit = embeddings._unit(rng.standard_normal((400, 64)))
    unit[1::2] = embeddings._unit(unit[::2] + rng.uniform(0.1, 1.5, (200, 1)) * unit[1::2])
    true = unit @ unit.T
    code, factor = embeddings.codes(unit)
    guess, spread = embeddings.estimates(unit, code, factor)
    off = ~np.eye(400, dtype=bool)
    error = ((guess - true) / spread)[off]
    assert abs(error.mean()) < 0.02 and (np.abs(error) > 2).mean() < 0.08 and (np.abs(error) > embeddings.SIGMAS).mean() < 1e-5
    assert np.allclose(guess.diagonal(), 1)


@pytest.mark.parametrize("turns", [1, 2])
def test_recall_at_the_threshold(turns):
    """Pairs with cosine just above 0.9 meet in some table."""
    rng = np.random.default_rng(turns)
    u = embeddings._unit(rng.standard_normal((3000, 64)))
    side = rng.standard_normal((3000, 64))
    side = embeddings._unit(side - (side * u).sum(axis=1, keepdims=True) * u)
    v = 0.901 * u + np.sqrt(1 - 0.901**2) * side
    tables = int(np.ceil(np.log(embeddings.MISS) / np.log(1 - embeddings.MEET**turns)))
    met = (embeddings.buckets(u, turns, tables) == embeddings.buckets(v, turns, tables)).any(axis=1)
    assert met.mean() >= 0.99


def test_recall_on_the_table(spark):
    """Against all pairs of the given table, by brute force."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    given = df.collect()
    unit = embeddings._unit(np.array([r.embedding for r in given], np.float64))
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    assert sum(got.values()) >= 0.99 * want.sum()
    assert all(got[r.vec_id] <= n for r, n in zip(given, want))


def test_more_vectors_take_more_tables():
    assert embeddings.tables_for(0)[0] == embeddings.tables_for(250_000)[0] == 1
    assert [embeddings.tables_for(n)[0] for n in (250_001, 30_000_000, 3_000_000_000)] == [2, 2, 3]
