import random

import numpy as np
import pytest
from helpers import documents

from chronolode.llm import decontaminate as dec
from chronolode.llm.queries import op1_decontaminate

RNG = random.Random(8)
COMMON = [f"c{i}" for i in range(30)]


def word(rng):
    return rng.choice(COMMON) if rng.random() < 0.5 else "".join(rng.choice("abcdefghij") for _ in range(7))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def bench(rng, n):
    return [(i, ". ".join(prose(rng, rng.randrange(8, 25)).capitalize() for _ in range(rng.randrange(1, 4))) + ".") for i in range(n)]


def reworded(rng, text, share):
    """The text with a share of its words replaced, all before its last quarter."""
    words = text.split()
    cut = len(words) - dec.answer_of(text)
    for i in rng.sample(range(cut), int(cut * share)):
        words[i] = prose(rng, 1)
    return " ".join(words)


def test_windows_cover_every_word():
    for lengths in ([0], [1, 0, 31, 32, 33], [48, 49, 100, 0]):
        text, begin, end = dec._windows(lengths)
        starts = np.cumsum([0, *lengths])
        seen = {p for b, e in zip(begin, end) for p in range(b, e)}
        assert seen == set(range(sum(lengths)))
        assert all(starts[t] <= b < e <= starts[t + 1] for t, b, e in zip(text, begin, end))
        for i, n in enumerate(lengths):
            assert [(b - starts[i], e - starts[i]) for t, b, e in zip(text, begin, end) if t == i] == dec.spots(n)


@pytest.mark.parametrize("seed", range(10))
def test_common_weight(seed):
    rng = np.random.default_rng(seed)
    a, b, w = rng.integers(0, 5, 7), rng.integers(0, 5, 12), rng.uniform(0.1, 3, 5)
    table = np.zeros((8, 13))
    for i in range(7):
        for j in range(12):
            table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + w[a[i]] if a[i] == b[j] else 0)
    assert np.isclose(dec.common_weight(a, b, w), table[-1, -1])


def test_words_and_answers():
    assert dec.words_of("It's ÉTÉ, x_1\nüber!") == [b"it", b"s", "été".encode(), b"x", b"1", "über".encode()]
    assert dec.answer_of("One two three four. Five six seven.") == 3
    assert dec.answer_of("a b c d e f g h") == 2 and dec.answer_of("a") == 1 and dec.answer_of("") == 1


def test_svd_spans_the_leading_vectors(spark):
    """Against a dense decomposition: the same space where the rank holds all, and nearly its energy where not."""
    items = bench(random.Random(3), 40)
    df = spark.createDataFrame(items, "item long, text string").repartition(3)
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in items for w in dec.words_of(t)}))}
    weights = np.append(np.random.default_rng(0).uniform(0.5, 5, len(vocabulary)), 6)
    rows = []
    for _, t in items:
        ids = dec._numbers(dec.words_of(t), vocabulary)
        for b, e in dec.spots(len(ids)):
            row = np.bincount(ids[b:e], minlength=len(vocabulary)) * weights[:-1]
            rows.append(row / np.linalg.norm(row))
    a = np.stack(rows)
    full = dec.randomised_svd(df, vocabulary, weights, 256)
    assert np.allclose(full.T @ full, np.eye(full.shape[1]), atol=1e-6) and np.allclose(a @ full @ full.T, a, atol=1e-6)
    some = dec.randomised_svd(df, vocabulary, weights, 20)
    best = (np.linalg.svd(a, compute_uv=False)[:20] ** 2).sum()
    assert some.shape[1] == 20 and ((a @ some) ** 2).sum() > 0.9 * best


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    items = bench(rng, 60)
    rows, want, near = [], set(), set()
    for i in range(400):
        parts = [prose(rng, rng.randrange(0, 300)), prose(rng, rng.randrange(0, 200))]
        if i % 8 == 0:
            k, text = rng.choice(items)
            want.add((i, k))
            parts.insert(1, text.upper() if i % 16 else text)
        elif i % 8 == 1:
            k, text = rng.choice(items)
            near.add((i, k))
            parts.insert(1, reworded(rng, text, 0.25))
        rows.append((i, "\n".join(parts)))
    return items, rows, want, near


def test_finds_copies_and_paraphrases(spark, case):
    items, rows, want, near = case
    found = dec.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert want <= got and len(near & got) >= 0.9 * len(near) and not got - want - near
    assert all(r.text_share > 0.999 and r.answer_share > 0.999 for r in found if (r.doc_id, r.item_id) in want)


def test_recall_against_all_pairs(spark, case):
    """Every document against every text by common subsequences alone: retrieval loses few of those it confirms."""
    items, rows, *_ = case
    space = dec.build_space(documents(spark, rows), spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(items)], "item long, item_id long, text string"))
    ids = [dec._numbers(dec.words_of(t), space.vocabulary) for _, t in rows]
    true = set()
    for d, doc in enumerate(ids):
        for i, item in enumerate(space.items):
            for b, e in dec.spots(len(doc)):
                a, z = max(0, b - len(item.words)), e + len(item.words)
                answer = item.words[len(item.words) - item.answer :]
                share = dec.common_weight(item.words, doc[a:z], space.weights) / space.weights[item.words].sum() if len(item.words) and np.isin(item.words, doc[a:z]).mean() > 0.4 else 0
                if share >= dec.COPIED or (share >= dec.REWORDED and dec.common_weight(answer, doc[a:z], space.weights) >= dec.ANSWERED * space.weights[answer].sum()):
                    true.add((d, i))
                    break
    got = {(t, i) for t, i, *_ in dec.confirm(space, np.concatenate(ids), [len(x) for x in ids])}
    assert len(true) > 90 and len(true & got) >= 0.95 * len(true) and not got - true


def test_blocks_and_odd_rows(spark, case, monkeypatch):
    items, rows, want, _ = case
    monkeypatch.setattr(dec, "BLOCK_ITEMS", 25)
    monkeypatch.setattr(dec, "CHUNK_WORDS", 500)
    odd = [(None, items[3][1]), (1000, None), (1001, ""), (1002, items[3][1] + " " + prose(random.Random(1), 60_000)), (1003, items[4][1]), (1003, items[4][1])]
    marks = [*items, (None, None), (100, ""), (101, "..."), (None, "an item without any number but with words"), (3, items[3][1])]
    docs = documents(spark, rows[:120] + odd, extra=True)
    benchmark = spark.createDataFrame(marks, "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in dec.contaminated(docs, benchmark).collect()]
    assert {w for w in want if w[0] < 120} <= set(got)
    assert got.count((None, 3)) == 2 and got.count((1002, 3)) == 2 and got.count((1003, 4)) == 2
    left = dec.drop_contaminated(docs, benchmark)
    assert left.columns == docs.columns
    ids = {r.doc_id for r in left.collect()}
    assert {None, 1000, 1001} <= ids and not ids & {1002, 1003, *(d for d, _ in want if d < 120)}
    assert dec.contaminated(docs.where("doc_id < 0"), benchmark).collect() == []
    assert dec.contaminated(docs, benchmark.where("item_id > 99")).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.item_id) for r in op1_decontaminate(spark, sf).collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {(r.doc_id, k) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for k, t in items if t in (r.text or "")}
    assert want <= got


def test_no_copy_is_lost_to_the_size_of_the_benchmark(spark):
    """Copies of 1,000 texts, many more passages than axes, and counts of a large corpus: every one is a candidate."""
    rng = random.Random(11)
    items = bench(rng, 1_000)
    reworded_texts = [reworded(rng, t, 0.25) for _, t in items]
    copies = [f"{prose(rng, rng.randrange(40))} {t} {prose(rng, rng.randrange(40))}" for t in [t for _, t in items] + reworded_texts]
    docs = documents(spark, [(i, prose(rng, 400)) for i in range(200)])
    space = dec.build_space(docs, spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(items)], "item long, item_id long, text string"))
    assert all(len(x.owner) <= dec.RANK for x in space.latents) and sum(len(x.owner) for x in space.latents) > 4 * dec.RANK
    # words outside the benchmark as rare as in a corpus of many passages
    space.weights[-1] = 25.0
    ids = [dec._numbers(dec.words_of(t), space.vocabulary) for t in copies]
    got = {(t, i) for t, i, *_ in dec.confirm(space, np.concatenate(ids), [len(x) for x in ids])}
    assert {(i, i) for i in range(1_000)} <= got
    assert sum((1_000 + i, i) in got for i in range(1_000)) >= 950


def test_long_benchmark_texts_are_cut_between_passages():
    texts = [[b"w%d" % i for i in range(n)] for n in (0, 5, 20_000, 33, 4_112)]
    groups = list(dec.pieces_of(texts))
    assert all(sum(len(dec.spots(len(ws))) for _, ws in g) <= dec.RANK for g in groups)
    for i, words in enumerate(texts):
        got = [tuple(ws[b:e]) for g in groups for k, ws in g if k == i for b, e in dec.spots(len(ws))]
        assert got == [tuple(words[b:e]) for b, e in dec.spots(len(words))]
