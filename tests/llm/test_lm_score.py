import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import documents

from chronolode.llm import lm_score as lm
from chronolode.llm.queries import op7_lm_score


def brute(rows, targets, size, slots):
    """Scores by plain counting, each document against models made anew without it."""
    split = [lm.tokens_of(t or "") for _, t in rows]
    total = Counter(w for ws in split for w in ws)
    vocabulary = {w: i + 1 for i, w in enumerate(sorted(total, key=lambda w: (-total[w], w))[:size])}
    pairs = [list(zip([65_535, *(vocabulary.get(w, 0) for w in ws)], (vocabulary.get(w, 0) for w in ws))) for ws in split]
    slot = lambda a, b: int(lm.slots_of(np.array([a]), np.array([b]), slots)[0])
    mark = [d is not None and d in targets for d, _ in rows]
    n = [sum(len(p) for p, m in zip(pairs, mark) if m == side) for side in (False, True)]
    scale = n[1] / n[0] if n[0] and n[1] else 1.0
    out = []
    for i, own in enumerate(pairs):
        means = []
        for side, factor in ((True, 1.0), (False, scale)):
            words, firsts, slotted = Counter(), Counter(), Counter()
            for j, p in enumerate(pairs):
                if mark[j] == side and j != i:
                    for a, b in p:
                        words[b] += 1
                        firsts[a] += 1
                        slotted[slot(a, b)] += 1
            loss = 0.0
            for a, b in own:
                single = (words[b] * factor + 1) / (sum(words.values()) * factor + len(vocabulary) + 1)
                pair = min(slotted[slot(a, b)], words[b], firsts[a]) * factor
                loss -= math.log2((pair + lm.PRIOR * single) / (firsts[a] * factor + lm.PRIOR))
            means.append(loss / max(len(own), 1))
        out.append((rows[i][0], mark[i], len(own), *means))
    return out


def test_tokens():
    assert lm.tokens_of("It's OK, x%%  É.") == [b"it", b"'", b"s", b"ok", b",", b"x", b"%", b"%", "é".encode(), b"."]


def test_slots():
    a, b = np.meshgrid(np.arange(300), np.arange(300))
    found = lm.slots_of(a.ravel(), b.ravel(), 1 << 10)
    assert found.min() >= 0 and found.max() < 1 << 10 and np.bincount(found, minlength=1 << 10).max() < 200


@pytest.mark.parametrize(("size", "slots"), [(6, 64), (500, 1 << 16)])
def test_by_brute_force(spark, size, slots, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 60)
    monkeypatch.setattr(lm, "COUNTER_WORDS", 5)
    rng = random.Random(size)
    rows = [(i, " ".join(rng.choice("a b c d e f, g. h".split()) for _ in range(rng.randrange(12)))) for i in range(40)]
    rows += [(None, "a b no id"), (50, None), (51, ""), (3, "a a a"), (3, "a a a"), (52, "b c " * 90)]
    targets = {i for i in range(0, 40, 3)}
    marks = spark.createDataFrame([(i,) for i in targets] + [(None,), (0,), (999,)], "doc_id long")
    found = [tuple(r) for r in lm.cross_entropy_difference(documents(spark, rows, extra=True), marks, size, slots).collect()]
    want = brute(rows, targets, size, slots)
    order = lambda r: (r[0] is None, r[0] or 0, r[2])
    for a, b in zip(sorted(found, key=order), sorted(want, key=order), strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:5], b[3:5], rtol=1e-4) and np.isclose(a[5], a[3] - a[4])


def test_no_pair_shares_a_count_with_another(spark, monkeypatch):
    """Without slots the counts are those of the pairs themselves, from several chunks and parts."""
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 700)
    monkeypatch.setattr(lm, "PART_TOKENS", 500, raising=False)
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(100))) for i in range(60)]
    targets = set(range(0, 60, 4))
    marks = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    found = sorted(tuple(r) for r in lm.cross_entropy_difference(documents(spark, rows), marks, 300).collect())
    for a, b in zip(found, brute(rows, targets, 300, 1 << 40), strict=True):
        assert a[:3] == b[:3] and np.allclose(a[3:5], b[3:5], rtol=1e-6)


def test_prefers_the_target(spark):
    rng = random.Random(1)
    texts = [("good", "north south east west up down"), ("bad", "red green blue north grey pink")]
    rows = [(i, " ".join(rng.choice(texts[i % 2][1].split()) for _ in range(40))) for i in range(200)]
    marks = spark.createDataFrame([(i,) for i in range(0, 100, 2)], "doc_id long")
    found = {r.doc_id: r.difference for r in lm.cross_entropy_difference(documents(spark, rows), marks).collect()}
    # documents of either kind that no label names, too
    assert max(found[i] for i in range(0, 200, 2)) < min(found[i] for i in range(1, 200, 2))


def test_without_documents_or_targets(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert lm.cross_entropy_difference(documents(spark, []), none).collect() == []
    rows = lm.cross_entropy_difference(documents(spark, [(1, "a b"), (2, None)]), none).collect()
    assert all(math.isfinite(r.difference) for r in rows) and len(rows) == 2


def test_query_ranks_the_labels(spark):
    """Documents of label 1 score lower than those of label 0 more often than not."""
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op7_lm_score(spark, sf).collect()
    good = [r.difference for r in rows if label.get(r.doc_id) == 1]
    bad = [r.difference for r in rows if label.get(r.doc_id) == 0]
    assert np.mean([g < b for g in good for b in bad]) > 0.6
