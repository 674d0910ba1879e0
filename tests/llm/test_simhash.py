import random
import re

import numpy as np
import xxhash
from helpers import documents, smallest_reachable
from pyspark.sql import functions as F

from chronolode.llm import simhash


def brute(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_fingerprint_of_any_text(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \n\t", "one", "One TWO", "a b c", "a\u00a0b c d", "ÄB É x y\u2003z w"]
    texts += [" ".join(rng.choice("ab cd ef gh É".split()) for _ in range(rng.randrange(60))) for _ in range(50)]
    whole = [simhash.fingerprint(t) for t in texts]
    assert whole == [brute(t) for t in texts]
    monkeypatch.setattr(simhash, "byte_chunks", lambda data: __import__("chronolode.llm.common", fromlist=["x"]).byte_chunks(data, 7))
    assert [simhash.fingerprint(t) for t in texts] == whole


def test_same_hash_as_spark(spark):
    df = spark.createDataFrame([("the quick brown",), ("ß é",)], "s string").select("s", F.xxhash64("s").alias("h"))
    assert all(xxhash.xxh64_intdigest(r.s.encode(), 42) == r.h % (1 << 64) for r in df.collect())


def planted(rng, n):
    base = [rng.getrandbits(64) for _ in range(n)] + [0, (1 << 64) - 1]
    out = set(base)
    for b in base:
        x = b
        for _ in range(4):  # chains of one to three bits
            for _ in range(rng.randrange(1, 4)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def check_links(spark, values):
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    near = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 2
    want = smallest_reachable(signed, near)
    edges = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3))
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {v: found.get(v, v) for v in signed} == want


def test_links_by_brute_force(spark):
    check_links(spark, planted(random.Random(3), 60))


def test_links_of_hot_variants(spark, monkeypatch):
    """More fingerprints under one variant than are compared at once."""
    rng = random.Random(5)
    same = rng.getrandbits(32)
    values = {same << 32 | rng.getrandbits(32) & 0xFF for _ in range(60)} | {same << 32 | rng.getrandbits(32) for _ in range(40)} | {rng.getrandbits(32) << 32 | same for _ in range(30)}
    monkeypatch.setattr(simhash, "HOT", 8)
    check_links(spark, sorted(values))


def test_documents(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    long = [word() for _ in range(900)]
    edited = [*long]
    edited[400] = "changed"
    rows = [(5, None), (3, ""), (9, "  \n"), (1, "two words"), (2, "two  WORDS"), (7, " ".join(long)), (6, " ".join(edited)), (8, " ".join(long)), (None, "nobody"), (8, " ".join(long)), (10, "w " * 300_000)]
    docs = documents(spark, rows, extra=True)
    found = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    fps = {i: brute(t) for i, t in rows if i is not None and i != 10} | {10: brute("w w w")}
    want = smallest_reachable(sorted(fps), lambda a, b: bin(fps[a] ^ fps[b]).count("1") <= 2)
    assert sorted((x for x in found if x[0] is not None)) == sorted((i, want[i]) for i, _ in rows if i is not None)
    assert (None, None) in found and len(found) == len(rows)
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id) == sorted({want[i] for i in fps})
    assert simhash.near_duplicates(docs.where("doc_id < 0")).count() == 0
