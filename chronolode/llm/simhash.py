"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments of 32. Of two fingerprints that differ in at most two bits, one
segment differs in at most one bit, so both have a common variant of that segment with one bit left out. Every distinct
fingerprint is indexed under its 64 variants, an equality shuffle brings equal variants together, and every candidate is
verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolode.llm.common import byte_chunks, components, fresh, kept, parts_of, text_of, tidy

SHINGLE = 3
SEED = 42
DISTANCE = 2
HOT = 16_384


def _hashes(data: bytes, size: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, in runs of bounded length."""
    rest: list[bytes] = []
    whole = True
    lower = data.lower()  # of bytes, so only A-Z change
    for chunk in byte_chunks(lower):
        words = rest + chunk.split()
        if len(words) >= size:
            whole = False
            grams = zip(*(words[i:] for i in range(size))) if size > 1 else zip(words)
            yield np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(seed)), np.uint64, len(words) - size + 1)
            rest = words[len(words) - size + 1 :]
        else:
            rest = words
    if whole and rest:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(rest), seed)], np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of one text, as an unsigned integer."""
    counts, n = np.zeros(64, np.int64), 0
    for hashes in _hashes((text or "").encode("utf-8", "surrogatepass"), size, seed):
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].astype("<u8")
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
        n += len(hashes)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text) with column fp, the fingerprint's 64 bits as BIGINT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            found = np.array([fingerprint(t, size, seed) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(tidy(run), "doc_id long, fp long")


def _variants(fps: DataFrame) -> DataFrame:
    """(key, fp): the number of the bit left out, above the rest of its segment."""
    seg = "CASE WHEN bit < 32 THEN fp & 4294967295L ELSE shiftrightunsigned(fp, 32) END"
    key = f"shiftleft(CAST(bit AS BIGINT), 32) | (({seg}) & ~shiftleft(1L, bit % 32))"
    return fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")).select(F.expr(key).alias("key"), "fp")


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= DISTANCE


def _joined(fps: np.ndarray, block: int = 512) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links among the fingerprints of one variant, thinned to few that join the same ones."""
    left, right = [], []
    root = np.arange(len(fps))
    for i in range(0, len(fps), block):
        for j in range(i, len(fps), 8 * block):
            p, q = np.nonzero(_near(fps[i : i + block, None], fps[None, j : j + 8 * block]))
            p, q = p + i, q + j
            new = root[p] != root[q]
            p, q = p[new], q[new]
            while len(p):
                low = np.minimum(root[p], root[q])
                np.minimum.at(root, root[p], low)
                np.minimum.at(root, root[q], low)
                while not np.array_equal(root, root[root]):
                    root = root[root]
                new = root[p] != root[q]
                p, q = p[new], q[new]
    moved = root != np.arange(len(fps))
    left.append(fps[moved])
    right.append(fps[root[moved]])
    return left, right


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the sorted rows (key, fp); variants with more than HOT fingerprints are returned as (key, null)."""

    def out(a, b, hot):
        a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a, b))
        keys = [*[None] * len(a), *hot]
        ends = [*a.view(np.int64).tolist(), *[None] * len(hot)], [*b.view(np.int64).tolist(), *[None] * len(hot)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (*ends, keys)], names=["a", "b", "hot"])

    held_key, held, held_n = None, [], 0

    def flush(a, b, hot):
        if held_n > HOT:
            hot.append(int(held_key))
        elif held_n > 1:
            x, y = _joined(np.concatenate(held))
            a += x
            b += y

    for batch in batches:
        keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        if not len(keys):
            continue
        starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        a, b, hot = [], [], []
        sizes = np.diff(starts)
        first_joins = held_key is not None and keys[0] == held_key
        if not first_joins:
            flush(a, b, hot)
            held_key, held, held_n = keys[0], [], 0
        # the first run continues the held one
        held_n += int(sizes[0])
        held = held + [fps[: starts[1]]] if held_n <= HOT else []
        if len(sizes) > 1:
            flush(a, b, hot)
            inner = np.arange(1, len(sizes) - 1)
            two = inner[sizes[inner] == 2]
            x, y = fps[starts[two]], fps[starts[two] + 1]
            near = _near(x, y)
            a.append(x[near])
            b.append(y[near])
            for r in inner[sizes[inner] > 2]:
                held_key, held, held_n = keys[starts[r]], [fps[starts[r] : starts[r + 1]]], int(sizes[r])
                flush(a, b, hot)
            held_key, held, held_n = keys[-1], [fps[starts[-2] :]], int(sizes[-1])
        if a or hot:
            yield out(a, b, hot)
    a, b, hot = [], [], []
    flush(a, b, hot)
    yield out(a, b, hot)


def _hot_links(fps: DataFrame, hot: DataFrame) -> DataFrame:
    """Links within variants of very many fingerprints, without comparing pairs.

    Under one variant all fingerprints agree in a segment but for one bit. Those that also agree in the other segment
    but for one bit differ in two bits at most; so do those with equal segments whose other segments agree but for two
    bits. Each such class joins all its members to its smallest.
    """
    rows = _variants(fps).join(hot, "key").withColumn("bit", F.expr("CAST(shiftright(key, 32) AS INT)"))
    other = F.expr("CASE WHEN bit < 32 THEN shiftrightunsigned(fp, 32) ELSE fp & 4294967295L END")
    rows = rows.withColumn("other", other)
    one = rows.select("key", "fp", F.lit(0).cast("tinyint").alias("own"), "other", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("i"))
    one = one.select("key", "fp", "own", F.col("i").alias("i"), F.col("i").alias("j"), F.expr("other & ~shiftleft(1L, i)").alias("rest"))
    own = F.expr("CAST((shiftrightunsigned(fp, bit) & 1) AS TINYINT) + 1")
    two = rows.select("key", "fp", own.cast("tinyint").alias("own"), "other", F.explode(F.sequence(F.lit(0), F.lit(30))).alias("i"))
    two = two.select("key", "fp", "own", "other", "i", F.explode(F.expr("sequence(i + 1, 31)")).alias("j"))
    two = two.select("key", "fp", "own", "i", "j", F.expr("other & ~(shiftleft(1L, i) | shiftleft(1L, j))").alias("rest"))
    classes = one.unionByName(two)
    low = classes.groupBy("key", "own", "i", "j", "rest").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return classes.join(low, ["key", "own", "i", "j", "rest"]).where("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def near_links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints (column fp) differing in at most two bits."""
    rows = _variants(fps).repartition("key").sortWithinPartitions("key")
    found = kept(rows.mapInArrow(tidy(_links), "a long, b long, hot long"), "simhash-links")
    hot = kept(found.where("hot IS NOT NULL").select(F.col("hot").alias("key")).distinct(), "simhash-hot")
    links = found.where("hot IS NULL").select("a", "b")
    return links if hot.isEmpty() else links.union(_hot_links(fps, hot))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Fingerprint and component of every row of ``docs`` (doc_id, text): doc_id, fp, component_id.

    Two rows are linked if their fingerprints differ in at most two bits; component_id is the smallest doc_id reachable.
    Null, empty or blank texts have fingerprint 0 and link like any other. Repeated rows stay repeated. Rows without
    doc_id are fingerprinted and link others, but never name a component; a component without any doc_id has a null
    component_id. An empty table gives no rows; further columns are ignored.
    """
    rows = kept(fingerprints(docs, size, seed), "fingerprints")
    fps = kept(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-classes")
    roots = components(near_links(fps))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = named.join(lows, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, its smallest doc_id; all columns stay.

    Rows without doc_id stay. Of rows that share the kept doc_id, all stay.
    """
    mark = fresh(docs, "component_id")
    ids = near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(ids, docs["doc_id"].cast("long") == ids[mark], "left_anti")
