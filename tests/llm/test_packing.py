import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronolode.llm import packing


def test_encoder_equals_tokenizer(monkeypatch):
    plain = Tokenizer.from_file(packing.default_tokenizer())
    rng = random.Random(2)
    parts = ["a", "Word", "it's", " ", "  ", "\n", "\t", "é", "1234", "…", " ", "　", "<|endoftext|>", "ß,", "\U0001f600", "\x1c", "\x85", "-", "don't", "it's,", "x***", "?!", "\nY", "w.", "\n\n", "12,", "é'", "²)", "e\u0301."]
    texts = ["a.\nb", "\na", "a\n", "a,\n\nb, c", "a\n\tb", "a \nb c", "a\nb c", "one, two, three.\nFour's, five", "a, ,b ,", "a\x1c,b c"] + ["", " ", "a", " a", "a ", "a  b", "a \nb", "a\n b"] + ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(25))) for _ in range(600)]
    for words in (10, 5_000):
        encoder = packing.Encoder(packing.default_tokenizer(), words)
        for at in range(0, len(texts), 50):
            for text, ids in zip(texts[at : at + 50], encoder.encode(texts[at : at + 50])):
                assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_cuts():
    assert packing.cuts(1, 4) == [0, 1] and packing.cuts(4, 4) == [0, 4] and packing.cuts(5, 4) == [0, 1, 5] and packing.cuts(12, 4) == [0, 4, 8, 12]


def best(lengths, size):
    """Fewest sequences by search (small inputs)."""
    lengths = sorted(lengths, reverse=True)
    low = len(lengths)

    def go(i, bins):
        nonlocal low
        if len(bins) >= low:
            return
        if i == len(lengths):
            low = len(bins)
            return
        for k in {b: j for j, b in enumerate(bins)}.values():
            if bins[k] + lengths[i] <= size:
                go(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return low


@pytest.mark.parametrize("seed", range(30))
def test_plan(seed):
    rng = random.Random(seed)
    size = rng.choice([10, 50])
    lengths = [rng.randrange(1, size + 1) for _ in range(11)]
    made = packing.plan(Counter(lengths), size)
    assert Counter(x for sizes, n in made for x in sizes * n) == Counter(lengths)
    assert all(sum(sizes) <= size for sizes, _ in made)
    assert sum(n for _, n in made) <= best(lengths, size) + 1


def test_two_replace_one():
    # greedy takes 6 and 3 (gap 1); 2 and 2 fill the place of 3 to the end
    assert packing.plan({6: 1, 3: 1, 2: 2}, 10)[0] == ([6, 2, 2], 1)
    assert packing.plan({}, 10) == []


def test_plan_of_many_is_tight():
    rng = np.random.default_rng(1)
    counts = Counter(np.clip(rng.lognormal(5.5, 1, 200_000).astype(int), 1, 1024).tolist())
    made = packing.plan(counts)
    total = sum(k * n for k, n in counts.items())
    assert sum(n for _, n in made) <= 1.01 * max(-(-total // 1024), 1)
    assert len(packing.places(made)) < 20_000


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 40)
    rows = [(i, "word " * (i % 37) + "é\n") for i in range(150)] + [(200, None), (201, ""), (None, "no id"), (202, "long text " * 3000), (7, "twice"), (7, "twice")]
    docs = documents(spark, rows, extra=True)
    got = packing.pack_documents(docs, length=64).withColumn("crc", F.crc32("ids")).collect()
    plain = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for i, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) % 64 or 64
        edges = [0, *range(first, len(ids) + 1, 64)] if len(ids) > 64 else [0, len(ids)]
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.crc) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.05 * -(-total // 64) + 1


def test_none_and_too_long(spark):
    assert packing.pack_documents(documents(spark, [])).collect() == []
    bad = spark.createDataFrame([(1, 0, 2000)], "doc_id long, piece int, length long")
    with pytest.raises(ValueError):
        packing.pack(bad)
