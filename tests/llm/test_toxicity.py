import itertools
import random

import numpy as np
import pytest
from helpers import documents
from pyspark.sql import functions as F

from chronolode.llm import toxicity
from chronolode.llm.queries import op4_toxicity
from chronolode.llm.toxicity import Field, Tagger, marginals


@pytest.mark.parametrize("seed", range(4))
def test_marginals_by_enumeration(seed):
    rng = np.random.default_rng(seed)
    change = rng.normal(size=(2, 2))
    lengths = np.array([1, 4, 6])
    scores = rng.normal(size=(3, 6)) * 3
    chance, pairs = marginals(scores, lengths, change, True)
    want_pairs = np.zeros((2, 2))
    for row, n in enumerate(lengths):
        weight, ones, two = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(scores[row, t] for t in range(n) if y[t]) + sum(change[a, b] for a, b in zip(y, y[1:])))
            weight += w
            ones += w * np.array(y)
            for a, b in zip(y, y[1:]):
                two[a, b] += w
        assert np.allclose(chance[row, :n], ones / weight) and not chance[row, n:].any()
        want_pairs += two / weight
    assert np.allclose(pairs, want_pairs)


def test_long_chains_do_not_overflow():
    chance, _ = marginals(np.full((1, 4000), 50.0), np.array([4000]), np.array([[2.0, -2.0], [-2.0, 2.0]]))
    assert np.allclose(chance, 1)


def test_training_follows_the_labels():
    given = [(6, [(1, ["=bad"], True), (2, ["=bad", "<ba"], True), (4, ["<ba"], False)])] * 30 + [(9, [(3, ["<ba"], False)])] * 30
    field = toxicity.train(given)
    bad, ba = field.weights.get("=bad", 0), field.weights.get("<ba", 0)
    chance, _ = marginals(field.bias + np.array([[0, bad, bad + ba, 0, ba, 0]]), np.array([6]), field.change)
    assert (np.round(chance) == [[0, 1, 1, 0, 0, 0]]).all() and chance[0, 1:3].min() > 0.8 and chance[0, 4] < 0.2


def test_tagger_takes_every_token_and_any_text(monkeypatch):
    field = Field({"=bad": 9.0}, -4.0, np.array([[0.5, -0.5], [-0.5, 0.5]]), (1.0, 0.0, 0.0))
    texts = ["", "\n \n", "one", "so bad!\nBAD bad, thing", "w " * 3000 + "bad", " bad\x1fbad\x85x", "x" * 5000]
    whole = Tagger(field).tag(texts)
    assert [len(c) for c in whole] == [len(t.split()) for t in texts]
    alone = [Tagger(field).tag([t])[0] for t in texts]
    assert all(np.allclose(a, b) for a, b in zip(whole, alone))
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 2)
    assert all(np.allclose(a, b) for a, b in zip(whole, Tagger(field).tag(texts)))
    for text, chance in zip(texts, whole):
        for begin, end in toxicity.spans(text, chance):
            assert "bad" in text[begin:end].lower() and not text[begin].isspace() and not text[end - 1].isspace()
    assert [texts[3][a:b] for a, b in toxicity.spans(texts[3], whole[3])] == ["bad!", "BAD bad,"]
    assert whole[4][-1] > 0.5 and whole[4][:-2].max() < 0.1


def planted(rng, n):
    words = ["alpha", "beta", "gamma", "delta", "the", "of"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) + rng.choice("abcdef") for _ in range(rng.randrange(3, 40))]
        if i % 5 == 0:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grumph", "GRUMPHish,", "(grumpher"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_learn_and_tag(spark):
    rng = random.Random(1)
    rows, labels = planted(rng, 300)
    fresh_rows, truth = planted(rng, 60)
    extra = [(None, "no id grumph grumphs"), (900, None), (901, ""), (902, "alphaa betab " * 20_000), (903, "grumphy grumphy"), (903, "grumphy grumphy")]
    marked = spark.createDataFrame([*labels, (None, 1), (2000, None), (3, 7)], "doc_id long, toxic int")
    field = toxicity.learn(documents(spark, [*rows, (None, "x")]), marked)
    docs = documents(spark, [(i + 1000, t) for i, t in fresh_rows] + extra, extra=True).withColumn("toxicity", F.lit("old"))
    tagged = toxicity.tag_documents(docs, field)
    got = {(r.doc_id, r.text): r.toxicity for r in tagged.collect()}
    assert tagged.count() == len(fresh_rows) + len(extra) and tagged.select("tags").first()[0] == {"a": 1}
    assert all((got[i + 1000, t] >= 0.5) == bool(y) for (i, t), (_, y) in zip(fresh_rows, truth))
    assert got[None, extra[0][1]] > 0.5 and got[900, None] < 0.5 and got[901, ""] < 0.5 and got[902, extra[3][1]] < 0.5
    left = toxicity.drop_toxic(docs.drop("toxicity"), marked.where("doc_id < 0"))
    assert left.count() == docs.count() and left.columns == docs.drop("toxicity").columns


def test_without_labels(spark):
    docs = documents(spark, [(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    for labels in (none, one):
        assert all(r.toxicity < 0.5 for r in toxicity.tag_documents(docs, toxicity.learn(docs, labels)).collect())
    assert toxicity.tag_documents(documents(spark, []), toxicity.learn(docs, none)).collect() == []


def test_held_out_rows_of_the_table(spark):
    """Accuracy where labels were not read."""
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = op4_toxicity(spark, sf).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
    assert any(r.predicted for r in rows) and all(0 <= r.score <= 1 for r in rows)


def test_every_part_of_a_token_is_read():
    field = Field({"=badword": 9.0}, -4.0, np.array([[0.5, -0.5], [-0.5, 0.5]]), (1.0, 0.0, 0.0))
    texts = ["fine " + "y" * 5000 + "badword", "xx" * 2500 + "badwordzz" + "q" * 300, "abc,badword;def ok", "some_badword_here", "badwords", "fine " + "y" * 5000]
    tops = [c.max() > 0.5 for c in Tagger(field).tag(texts)]
    assert tops == [True, True, True, True, False, False]


def test_chains_without_forms_are_computed_once():
    rng = random.Random(2)
    field = Field({"=bad": 3.0, "<goo": -1.5}, -2.0, np.array([[0.7, -0.9], [-0.4, 0.8]]))
    texts = ["\n".join(" ".join(rng.choice(["a", "b", "c", *(["bad", "good"] if rng.random() < 0.1 else [])]) for _ in range(rng.randrange(40))) for _ in range(9)) for _ in range(30)]
    for text, got in zip(texts, Tagger(field).tag(texts)):
        want = [marginals(np.array([[field.emission(w) for w in c]]), np.array([len(c)]), field.change)[0][0] for c in toxicity.chains(text)]
        assert np.allclose(got, np.concatenate([np.zeros(0), *want]), atol=1e-12)


def test_training_does_not_depend_on_partitions(spark):
    rows, labels = planted(random.Random(5), 200)
    docs, marked = documents(spark, rows + [(i + 5000, t) for i, t in rows[:40]]), spark.createDataFrame(labels + [(i + 5000, y) for i, y in labels[:40]], "doc_id long, toxic int")
    one = toxicity.learn(docs, marked)
    two = toxicity.learn(docs.repartition(7), marked.repartition(5))
    assert one.weights == two.weights and np.allclose(one.curve, two.curve)


def test_clashing_and_dotted_columns(spark):
    docs = documents(spark, [(1, "a"), (2, None)]).selectExpr("*", "'t' AS toxicity", "'w' AS toxic_words", "1 AS `a.b`", "2 AS document_toxicity")
    left = toxicity.drop_toxic(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert left.columns == docs.columns
    assert [tuple(r)[5:] for r in left.collect()] == [("t", "w", 1, 2)] * 2
