"""Near-duplicate vectors by randomised-rotation binary codes.

Every distinct vector is normalised, rotated by a seeded random rotation into ``CODE_BITS`` dimensions and stored as the
signs there, with a correction factor: the inner product of the vector and its sign vector. For another vector, the
inner product with the signs over that factor is an unbiased estimate of the cosine, and its spread is known from the
factor. Pairs whose upper confidence bound is below the threshold are left; the others are computed anew in doubles.

Pairs to estimate are those that share a bucket of some table. Buckets are the largest coordinates after further seeded
rotations; more vectors take more rotations a bucket, and more tables keep the chance to meet. A bucket of any size is
cut into blocks that are compared two at a time, so no task holds more than two blocks, and blocks give back counts and
a spanning forest of links, never pairs. A pair that shares several tables counts in the first of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolode.llm.common import _forest, components, kept

THRESHOLD = 0.9
CODE_BITS = 128
#: Standard deviations of the estimate in a confidence bound.
SIGMAS = 5.0
BLOCK = 2048
SEED = 7_919
#: Vectors for each further rotation in a bucket, and the chance to meet in one rotation that is counted on.
ROTATION_ROWS = 250_000
MEET = 0.5
MISS = 0.001


@lru_cache(maxsize=64)
def rotation(rows: int, dims: int, number: int) -> np.ndarray:
    """A seeded matrix of orthonormal columns (rows >= dims)."""
    rng = np.random.Generator(np.random.PCG64([SEED, rows, dims, number]))
    return np.linalg.qr(rng.standard_normal((rows, dims)))[0]


def tables_for(n: int) -> tuple[int, int]:
    """Rotations of a bucket and number of tables for n vectors."""
    turns = 1 + max(0, math.ceil(math.log(max(n, 1) / ROTATION_ROWS, 128)))
    return turns, math.ceil(math.log(MISS) / math.log(1 - MEET**turns))


def buckets(unit: np.ndarray, turns: int, tables: int) -> np.ndarray:
    """Bucket numbers, a row for each vector and a column for each table."""
    found = np.zeros((len(unit), tables), np.int64)
    dims = unit.shape[1]
    for t in range(tables):
        for k in range(turns):
            turned = unit @ rotation(dims, dims, 1 + t * turns + k)
            top = np.abs(turned).argmax(axis=1)
            side = turned[np.arange(len(unit)), top] < 0
            found[:, t] = found[:, t] * (2 * dims) + 2 * top + side
    return found


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs after rotation, and the correction factors."""
    size = max(CODE_BITS, -(-unit.shape[1] // 8) * 8)
    turned = unit @ rotation(size, unit.shape[1], 0).T
    return np.packbits(turned >= 0, axis=1, bitorder="little"), np.abs(turned).sum(axis=1) / math.sqrt(size)


def estimates(unit: np.ndarray, code: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of all ``unit`` (rows) to coded vectors (columns), and one standard deviation by column."""
    size = code.shape[1] * 8
    signs = np.unpackbits(code, axis=1, bitorder="little").astype(np.float32) * 2 - 1
    turned = (unit @ rotation(size, unit.shape[1], 0).T).astype(np.float32)
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(size - 1)
    return turned @ signs.T / (factor * math.sqrt(size)).astype(np.float32), spread


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Doubles of each list; none where it is null, empty, zero, or holds null or non-finite numbers."""
    found = []
    for item in column:
        values = None
        if item.is_valid and len(item.values) and not item.values.null_count:
            values = item.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(values).all() or not values.any():
                values = None
        found.append(values)
    return found


def _unit(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _vectors(batch.column(2))
        vectors = pa.array([None if v is None else v.astype("<f8").tobytes() for v in found], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), vectors], names=["row_id", "vec_id", "vec"])


def _coded(turns: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(1).to_pylist()
            order = sorted(range(len(vec)), key=lambda i: len(vec[i]))
            at = 0
            while at < len(order):  # vectors of one length at a time
                end = at
                while end < len(order) and len(vec[order[end]]) == len(vec[order[at]]):
                    end += 1
                part = order[at:end]
                unit = _unit(np.frombuffer(b"".join(vec[i] for i in part), "<f8").reshape(len(part), -1))
                code, factor = codes(unit)
                home = buckets(unit, turns, tables)
                picked = batch.take(pa.array(part))
                columns = [*picked.columns, pa.array([c.tobytes() for c in code]), pa.array(factor), pa.array(home.tolist(), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "code", "factor", "home"])
                at = end

    return run


def _compare(part: pa.Table) -> pa.Table:
    """Links among the vectors of one block, or between two blocks, of one bucket."""
    table = part.column("tab")[0].as_py()
    ids, weight = part.column("cid").to_numpy(), part.column("n").to_numpy()
    unit = _unit(np.frombuffer(b"".join(part.column("vec").to_pylist()), "<f8").reshape(len(ids), -1))
    code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
    factor = part.column("factor").to_numpy()
    home = np.array(part.column("home").to_pylist(), np.int64)[:, :table]
    block = part.column("block").to_numpy()
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    same = block.min() == block.max()
    counts = np.zeros(len(ids), np.int64)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(left), 256):
        rows = left[at : at + 256]
        guess, spread = estimates(unit[rows], code[right], factor[right])
        i, j = np.nonzero(guess + SIGMAS * spread.astype(np.float32) >= THRESHOLD)
        i, j = rows[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        if table and len(i):
            new = ~(home[i] == home[j]).any(axis=1)
            i, j = i[new], j[new]
        for k in range(0, len(i), 65_536):
            x, y = i[k : k + 65_536], j[k : k + 65_536]
            close = np.einsum("ij,ij->i", unit[x], unit[y]) >= THRESHOLD
            x, y = x[close], y[close]
            np.add.at(counts, x, weight[y])
            np.add.at(counts, y, weight[x])
            if len(x):
                u, v = _forest(ids[x], ids[y])
                a.append(u)
                b.append(v)
    a, b = _forest(np.concatenate(a), np.concatenate(b))
    linked = np.flatnonzero(counts)
    none = lambda n: pa.nulls(n, pa.int64())
    columns = [(pa.array(ids[linked]), none(len(a))), (pa.array(counts[linked]), none(len(a))), (none(len(linked)), pa.array(a)), (none(len(linked)), pa.array(b))]
    return pa.table([pa.concat_arrays(c) for c in columns], names=["cid", "links", "a", "b"])


def near_vectors(vectors: DataFrame) -> DataFrame:
    """Links of every row of ``vectors`` (vec_id, embedding) by cosine of at least 0.9 in double precision.

    Returns vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable, itself included) and
    kept (vec_id = component_id), one row per input row; further columns are ignored. Vectors that are null, empty,
    zero, or hold null or non-finite numbers link with nothing; neither do vectors of different lengths. Rows with equal
    vectors are one class and are linked with each other. Rows without vec_id are compared like others and count as
    links; in a component of such rows alone, component_id and kept are null. Repeated vec_ids stay separate rows.

    Pairs are found by chance: with the settings above, one at the threshold is missed about once in 1,000 or less.
    """
    source = vectors.select(F.monotonically_increasing_id().alias("row_id"), F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = kept(source.mapInArrow(_encode, "row_id long, vec_id long, vec binary"), "vectors")
    classes = rows.where("vec IS NOT NULL").groupBy("vec").agg(F.min("row_id").alias("cid"), F.count("*").alias("n"), F.min("vec_id").alias("low"))
    classes = kept(classes.select("cid", "vec", "n", "low"), "vector-classes")
    turns, tables = tables_for(classes.count())
    coded = kept(classes.mapInArrow(_coded(turns, tables), "cid long, vec binary, n long, low long, code binary, factor double, home array<long>"), "vector-codes")

    placed = coded.select("cid", F.octet_length("vec").alias("size"), F.posexplode("home").alias("tab", "bucket"))
    key = ["size", "tab", "bucket"]
    sizes = placed.groupBy(key).agg(F.count("*").alias("members")).where("members > 1")
    dealt = coded.select("cid", "vec", "n", "code", "factor", "home", F.octet_length("vec").alias("size"), F.posexplode("home").alias("tab", "bucket")).join(sizes, key)
    dealt = dealt.withColumn("blocks", F.expr(f"CAST(ceil(members / {BLOCK}) AS INT)")).withColumn("block", F.expr("CAST(pmod(xxhash64(cid), blocks) AS INT)"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other")).drop("blocks", "members", "other")
    found = kept(dealt.groupBy(*key, "one", "two").applyInArrow(_compare, "cid long, links long, a long, b long"), "vector-links")

    links = found.where("cid IS NOT NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.where("a IS NOT NULL").select("a", "b"))
    named = classes.join(links, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.select("cid", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "cid").alias("root"), "low")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "root").select("vec", "n_links", "component_id")
    joined = rows.join(named, "vec", "left")
    alone = F.col("vec").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
