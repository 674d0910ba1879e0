"""The pipeline, stage by stage, against plain loops over a small corpus with planted cases."""

import random

import corpus_pipeline
import pytest
from helpers import smallest_reachable
from pyspark.sql import functions as F
from test_lines import within_one
from test_simhash import brute as fingerprint

from chronolode.llm import decontaminate, lines, toxicity
from chronolode.llm.queries import llm_queries

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(12)
    benchmark = [(i, prose(rng, 30).capitalize() + ".") for i in range(10)]
    common = prose(rng, 20)
    texts = {}
    for i in range(300):
        texts[i] = "\n".join(prose(rng, rng.randrange(12, 60)) for _ in range(rng.randrange(1, 5)))
    toxic = set(range(0, 300, 6))
    for i in toxic:
        words = texts[i].split(" ")
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(["vilgrumph", "vilgrumpher", "vilgrumphing"]))
        texts[i] = " ".join(words)
    leaks = set(range(1, 300, 37)) - toxic
    for i in leaks:
        texts[i] += " " + benchmark[i % 10][1]
    for i in range(2, 300, 15):
        texts[i] += f"\n{common}" + ("x" if i % 2 else "")
    texts[301] = texts[5]  # an exact copy
    words = texts[7].split(" ")
    texts[302] = " ".join([words[0] + "changed", *words[1:]]).replace("\n", " ")  # a near copy without equal lines
    texts[303], texts[304], texts[305] = None, "", "long words " * 4000
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in texts.items()] + [(None, prose(rng, 20), None, None, 3)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(250)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, toxic, leaks, benchmark


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    """Rows before the first stage and after every stage, each written and read again."""
    path = corpus[0]
    out, docs = [spark.read.parquet(f"{path}/documents.parquet").collect()], spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        target = str(tmp_path_factory.mktemp("stage") / name)
        columns = docs.columns
        df = stage(spark, docs, path)
        assert name == "packing" or df.columns == columns
        df.write.parquet(target)
        docs = spark.read.parquet(target)
        out.append(docs.collect())
    return out


def pairs(rows):
    return sorted(((r.doc_id, r.text, r.n_chars) for r in rows), key=str)


def test_toxicity(spark, corpus, stages):
    path, rows, toxic, *_ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    field = toxicity.learn(docs, spark.read.parquet(f"{path}/labels.parquet").where(~toxicity.held_out(F.col("doc_id"))))
    tagger = toxicity.Tagger(field)
    want = [r for r in stages[0] if toxicity.score(field, tagger.tag([r.text or ""])[0]) < 0.5]
    assert pairs(stages[1]) == pairs(want)
    assert {r[0] for r in rows} - {r.doc_id for r in stages[1]} == toxic


def test_lines(stages):
    far = 1 << 63
    listed = [(far if r.doc_id is None else r.doc_id, n, x) for r in stages[1] for n, x in enumerate((r.text or "").split("\n"))]
    long = [x for x in listed if len(x[2]) >= lines.MIN_CHARS]
    gone = {(d, n) for d, n, x in long if any((e, m) < (d, n) and abs(len(x) - len(y)) < 2 and within_one(x, y) for e, m, y in long)}
    want = []
    for r in stages[1]:
        d = far if r.doc_id is None else r.doc_id
        parts = [x for n, x in enumerate((r.text or "").split("\n")) if (d, n) not in gone]
        if parts:
            text = None if r.text is None else "\n".join(parts)
            changed = any(e == d for e, _ in gone)
            want.append((r.doc_id, text, len(text) if changed or text is not None else None))
    assert [x[:2] for x in pairs(stages[2])] == [x[:2] for x in sorted(want, key=str)]
    assert gone and 301 not in {r.doc_id for r in stages[2]}


def test_near_duplicates(stages):
    prints = {r.doc_id: fingerprint(r.text if r.doc_id != 305 else "long words long words") for r in stages[2] if r.doc_id is not None}
    want = set(smallest_reachable(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2).values())
    left = {r.doc_id for r in stages[3]}
    assert {d for d in left if d is not None} - {305} == want - {305} and None in left
    assert {303, 304} & left == {303}  # two texts without words are one group


def test_contamination(corpus, stages):
    texts = {k: decontaminate.words_of(t) for k, t in corpus[4]}

    def holds(text):
        words = decontaminate.words_of(text or "")
        return any(words[i : i + len(w)] == w for w in texts.values() for i in range(len(words) - len(w) + 1))

    want = {r.doc_id for r in stages[3] if not holds(r.text)}
    assert {r.doc_id for r in stages[4]} == want and corpus[3] and not corpus[3] & want
    assert pairs(stages[4]) == pairs([r for r in stages[3] if r.doc_id in want])


def test_packing_and_run(spark, corpus, stages):
    from chronolode.llm.packing import LENGTH, Encoder, cuts, default_tokenizer

    encoder = Encoder(default_tokenizer())
    want = sorted((str(r.doc_id), i, a, b - a) for r in stages[4] for e in [cuts(len(encoder.encode([r.text or ""])[0]) // 4 + 1, LENGTH)] for i, (a, b) in enumerate(zip(e, e[1:])))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length) for r in stages[5]) == want
    spans = sorted((r.sequence_id, r.offset, r.length) for r in stages[5])
    for (s, o, n), (t, p, _) in zip(spans, spans[1:]):
        assert (t, p) == (s, o + n) or (t > s and p == 0)
    assert max(o + n for _, o, n in spans) <= LENGTH
    again = corpus_pipeline.run(spark, corpus[0])
    assert sorted(map(str, again.collect())) == sorted(map(str, stages[5]))


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert set(llm_queries()) <= set(names) and names["pipeline"] is corpus_pipeline.run
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{i}" for i in range(1, 11)]
