"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolode.session import scratch

WORD_CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: it is computed once and outlives its executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(column: Column | str) -> Column:
    """The column as text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for mapInArrow, giving memory back to the system when a task ends, as the next uses the same process."""

    @wraps(run)
    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


def parts_of(batches: Batches, rows: int = 256) -> Batches:
    """The batches in slices of a few rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def byte_chunks(data: bytes, size: int = WORD_CHUNK) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes, cut in front of white space, so that no word is cut."""
    start = 0
    while len(data) - start > size:
        cut = start + size
        while cut < len(data) and data[cut] not in b" \t\n\r\x0b\x0c":
            cut += 1
        yield data[start:cut]
        start = cut
    yield data[start:]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node that has a smaller node in its component, with the smallest one."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        root = root[root]
        if np.array_equal(before, root):
            break
    inner = root != np.arange(len(nodes))
    return nodes[inner], nodes[root[inner]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace every run of edges by as few edges that join the same nodes."""
    for batch in batches:
        a, b = _forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of the undirected edges (a, b), both BIGINT and not null.

    Returns (node, root) for every node that has a smaller node in its component; root is the smallest. Edges are
    first thinned batch by batch, then alternating large-star and small-star rounds join each node to the smallest
    it knows until nothing changes. Each round is a plain grouping and join (adaptive execution splits hot nodes), and
    is written to the shared folder.
    """
    links = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    links = kept(links.mapInArrow(_contract, "a long, b long"), "links")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    last = mark(links)
    if last[0] == 0:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(rounds):
        both = links.union(links.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = kept(small.where("a <> b").distinct(), "links")
        now = mark(links)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
