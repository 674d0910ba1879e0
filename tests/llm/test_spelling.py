import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from helpers import documents

from chronolode.llm import spelling
from chronolode.llm.queries import llm_queries

SF = "/root/testdata/sf0.001"


def near(words):
    """{word: near words}, by trying every edit."""
    letters = sorted({c for w in words for c in w})
    out = {}
    for w in words:
        tried = {w[:i] + w[i + 1 :] for i in range(len(w))}
        tried |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        tried |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        out[w] = (tried & set(words)) - {w}
    return out


def brute(rows, slips):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if slips and h % slips == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    others, form = near(words), {}
    for w, n in words.items():
        best = min(others[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(others[w]), form[w] and words[form[w]]) for w, n in words.items())


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 97)
    got = found(llm_queries()["op13_spelling"](spark, SF))
    assert got == want and sum(r[1] is not None for r in got) > 100


@pytest.mark.parametrize("slips", [None, 2])
def test_edits_runs_and_chains(spark, slips):
    rng = random.Random(4)
    words = "hello heello helloo hallo helo hellö Études études aaaaa aaaaaa aaaa bbbbb cat abcde abcdx abcxe".split()
    rows = [(i, " ".join(w for w in words for _ in range(rng.randrange(2 ** (k % 6) + 3)))) for k, w in enumerate(words) for i in (k, k)]
    rows += [(None, "hello, HELLO; Helloİ ÉTUDES etudes"), (90, None), (91, ""), (92, " 12_3 "), (93, "wordword " * 200_000)]
    got = found(spelling.spelling_variants(spelling.vocabulary(documents(spark, rows, extra=True), slips)))
    assert got == brute(rows, slips)


def test_many_random_words(spark):
    rng = random.Random(8)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))): rng.randrange(3, 400) for _ in range(900)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    got = {r.word: r for r in spelling.spelling_variants(df).collect()}
    others = near(words)
    assert {w: r.n_near for w, r in got.items()} == {w: len(x) for w, x in others.items()}
    for w, r in got.items():
        best = min(others[w], key=lambda o: (-words[o], o), default=None)
        assert r.form == (best if best and words[best] >= 2 * words[w] else None)


def test_groups_cut_by_batches():
    rows = sorted((p, c, True, n) for p, c, n in [("bcd$a", "e", 3), ("bcd$a", "f", 9), ("bcd$a", "", 4), ("x$yz", "q", 1), ("z$y", "a", 2), ("z$y", "b", 2)])
    schema = pa.schema([("prefix", pa.string()), ("skipped", pa.string()), ("single", pa.bool_()), ("n", pa.int64())])
    batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r))], schema=schema) for r in rows]
    one = [r for b in spelling._scanned(iter(batches)) for r in b.to_pylist()]
    whole = [r for b in spelling._scanned(iter([pa.concat_batches(batches)])) for r in b.to_pylist()]
    assert one == whole and {(r["word"], r["n_near"], r["best"]) for r in one if r["word"].startswith("a")} == {("abcd", 2, "afbcd"), ("aebcd", 2, "afbcd"), ("afbcd", 2, "abcd")}


def test_nothing(spark):
    docs = documents(spark, [(1, None), (2, "")])
    assert spelling.spelling_variants(spelling.vocabulary(docs, 97)).count() == 0
    assert spelling.spelling_variants(spelling.vocabulary(docs.where("doc_id > 5"))).count() == 0
