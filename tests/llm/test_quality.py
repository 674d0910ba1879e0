import numpy as np
import pytest
from helpers import documents
from pyspark.sql import functions as F

from chronolode.llm import common, quality
from chronolode.llm.queries import llm_queries

SF = "/root/testdata/sf0.01"


def test_held_out_labels(spark):
    scored = llm_queries()["op12_quality"](spark, SF)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    assert scored.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = [(r.predicted == 1) == (r.quality == 1) for r in rows]
    low = [r for r in rows if r.quality == 0]
    assert len(rows) > 80 and np.mean(right) > 0.97 and np.mean([r.predicted == 0 for r in low]) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def walk(trees, row):
    margin = trees.base
    for t in range(len(trees.feature)):
        at = 0
        while at < trees.feature.shape[1]:
            at = 2 * at + 1 + bool(row[trees.feature[t, at]] > trees.cut[t, at])
        margin += trees.leaf[t, at - trees.feature.shape[1]]
    return 1 / (1 + np.exp(-margin))


def test_trees_learn_and_walk():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(600, 5)).round(1)
    labels = ((rows[:, 1] > 0.3) ^ (rows[:, 3] < -0.2)).astype(float)
    trees = quality.grow(rows, labels, 40)
    again = quality.grow(rows, labels, 40)
    assert all((getattr(trees, a) == getattr(again, a)).all() for a in ("feature", "cut", "leaf"))
    scores = trees.scores(rows)
    assert np.allclose(scores, [walk(trees, r) for r in rows]) and ((scores > 0.5) == labels).mean() > 0.98


def test_first_cut_is_the_best(monkeypatch):
    """The root's cut against all cuts of all statistics."""
    rng = np.random.default_rng(5)
    rows, labels = rng.integers(0, 9, size=(200, 4)).astype(float), rng.integers(0, 2, 200).astype(float)
    labels[rows[:, 2] > 4] = 1
    trees = quality.grow(rows, labels, 1)
    p = (labels.sum() + 1) / (len(labels) + 2)

    def part(which):
        g, h = (labels - p)[which].sum(), which.sum() * p * (1 - p)
        return g * g / (h + quality.SMOOTH)

    gains = {(f, c): part(rows[:, f] <= c) + part(rows[:, f] > c) for f in range(4) for c in np.arange(0.5, 8)}
    best = max(gains, key=gains.get)
    assert (trees.feature[0, 0], trees.cut[0, 0]) == best == (2, 4.5)


@pytest.mark.parametrize("labels", [np.zeros(30), np.ones(30)])
def test_one_label_only(labels):
    trees = quality.grow(np.arange(60.0).reshape(30, 2), labels, 5)
    assert ((trees.scores(np.zeros((3, 2))) > 0.5) == labels[:3]).all()


def test_statistics(monkeypatch):
    assert quality.statistics(b"") == [0.0] * len(quality.NAMES)
    text = "THE Cat sat. the cat's *** Über\n\nThe cat|sat!!\n" * 9
    whole = dict(zip(quality.NAMES, quality.statistics(text.encode())))
    assert whole["newline"] == text.count("\n") / len(text.encode()) and whole["kinds_of_lines"] == 2 / 18
    assert whole["blank_lines"] == 10 / 28 and whole["bar"] == 9 / len(text.encode()) and whole["wide"] == 9 / len(text)
    monkeypatch.setattr(quality, "byte_chunks", lambda data: common.byte_chunks(data, 11))
    parts = dict(zip(quality.NAMES, quality.statistics(text.encode())))
    assert {k for k in parts if parts[k] != whole[k]} == {"packed"}
    for odd in ["\n", " \t", "a", "é" * 50, "x" * 2_000_000, "\x00\x01", "! " * 100, "中文" * 80]:
        row = quality.statistics(odd.encode())
        assert len(row) == len(quality.NAMES) and np.isfinite(row).all()


def test_odd_rows(spark):
    good, bad = "The cat sat on the mat, and it was good. ", "WIN!!! $$$ CLICK!!! "
    rows = [(i, (good if i % 2 else bad) * (3 + i % 7)) for i in range(80)] + [(5, good), (None, bad), (91, None), (92, ""), (93, "word " * 400_000)]
    docs = documents(spark, rows, extra=True).withColumn("quality", F.lit("q")).withColumn("text.read", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(5, 0), (7, None), (None, 1), (999, 1), (92, 0)], "doc_id long, quality int")
    trees = quality.learn(docs, labels)
    scored = quality.score_documents(docs, trees)
    assert scored.columns == [*docs.columns, "_quality"] and scored.where("quality = 'q'").count() == len(rows)
    got = {(r.doc_id, r.text): r._quality for r in scored.select("doc_id", "text", "_quality").collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[(91, None)] == got[(92, "")]
    assert all(got[r] > 0.5 for r in rows[:80] if r[0] % 2 and r[0] != 5) and all(got[r] < 0.5 for r in rows[:80] if r[0] % 2 == 0)
    dealt = quality.learn(docs.repartition(9), labels.repartition(4))
    assert (dealt.feature == trees.feature).all() and (dealt.leaf == trees.leaf).all()
    few = quality.learn(docs, labels, sample=10)
    assert few.feature.shape == trees.feature.shape


def test_nothing(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    none = quality.learn(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert [r.quality for r in quality.score_documents(docs, none).collect()] == [0.5, 0.5]
    assert quality.score_documents(docs.where("doc_id > 9"), none).count() == 0


def test_shapes_have_the_lengths_and_forms_of_the_words():
    text = "".join(chr(i) + ("x" if i % 3 else " Ab") for i in range(256)) + " ÉTÉ été's (Wort) a_b 0.5!! \"so\" it's. ½x²- "
    form = lambda w: fit.lastindex if (fit := quality._FORM.match(w)) else 0
    for given in (text, "", " \x85\xa0", text + " ’α١"):  # the last is beyond Latin-1
        words = given.split()
        assert [(len(s), form(s)) for s in quality.shapes(given)] == [(len(w), form(w)) for w in words]
    # matched are kinds of shapes, which stay few however many words there are
    assert len(set(quality.shapes(" ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500))))) == 1


def test_statistics_of_many_texts_are_those_of_each():
    texts = [b"", "Ein Satz. Noch EINER!\n\nso so".encode(), b" \n", b"x" * 100 + b" y", "中 text".encode()]
    rows = quality.statistics_of(texts)
    assert [list(row) for row in rows] == [quality.statistics(t) for t in texts] and not rows[0].any()
    assert quality.statistics_of([]).shape == (0, len(quality.NAMES))
