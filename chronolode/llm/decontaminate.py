"""Benchmark decontamination by latent semantic retrieval.

Benchmark texts are cut into passages and weighted by TF-IDF, where the document frequencies of their words are counted
over the passages of all documents. A randomised SVD of that matrix, whose products are summed over the partitions that
hold its rows, gives a latent space. Every passage of every document (overlapping windows of words) is folded into it,
and windows whose cosine with a benchmark passage reaches ``SIMILARITY``, or that cover ``COVERED`` of its energy, are
candidates. A candidate is confirmed by the longest common subsequence of words around the window, weighted like the
words; a paraphrase that keeps less of the text must also hold its answer, the end of the text.

A space has at most ``RANK`` passages, as many as it has axes, so it holds all their energy; larger benchmarks have
several, which are searched side by side. Two windows in a row hold every word of a passage that is copied, so one of
them covers half its energy at least, whatever stands beside the copy: copies are candidates without exception.

Words of no benchmark text are outside the spaces; each counts in the length of a window with the greatest weight. What
each word can add to the inner product with any benchmark passage bounds a window's cosines and cover, so windows whose
bounds are too small are left before they are folded in, without any loss. Benchmarks are taken in blocks of
``BLOCK_ITEMS``, which bounds what tasks are given.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolode.llm.common import fresh, kept, parts_of, text_of, tidy

STEP = 16
WINDOW = 2 * STEP
RANK = 256
OVERSAMPLING = 16
BLOCK_ITEMS = 2_000
SUM_GROUPS = 32
SIMILARITY = 0.3
#: Share of a passage's energy in a window; verbatim copies have 0.5 in one window at least.
COVERED = 0.4
#: Shares of a text's weight in the common subsequence: enough alone, and enough with that share of its answer.
COPIED, REWORDED, ANSWERED = 0.7, 0.5, 0.8
SEED = 40_503
CHUNK_WORDS = 200_000

#: ASCII that is neither letter nor digit parts words; so words of any script stay whole.
_PARTS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_SENTENCE = re.compile(r"[.!?…。]+(?=\s|$)")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_PARTS).split()


def answer_of(text: str) -> int:
    """How many words at the end of a text are its answer: its last sentence, or else its last quarter."""
    words, sentences = len(words_of(text)), [s for s in _SENTENCE.split(text) if words_of(s)]
    last = len(words_of(sentences[-1])) if len(sentences) > 1 else 0
    return last if 3 <= last < words else max(1, math.ceil(words / 4))


@dataclass
class Item:
    item_id: int | None
    words: np.ndarray  # numbers in the vocabulary
    answer: int


@dataclass
class Latent:
    """Latent space of at most RANK passages."""

    words: np.ndarray  # numbers of its words, sorted
    axes: np.ndarray  # [word, axis]
    passages: np.ndarray  # [passage, axis], unit rows
    norms: np.ndarray  # of the passages before
    owner: np.ndarray  # item of each passage
    gain: np.ndarray  # of each word, the most it can add to the inner product with a unit passage
    cover: np.ndarray  # of each word, the most it can add to the covered share of a passage


@dataclass
class Space:
    """Vocabulary, weights and latent spaces of one block of benchmark texts."""

    vocabulary: dict[bytes, int]
    items: list[Item]
    weights: np.ndarray  # of words; the last is that of all others
    latents: list[Latent]


def spots(n: int) -> list[tuple[int, int]]:
    """Where the windows of n words begin and end: one every STEP words, and one that reaches the end."""
    last = max(0, -(-(n - WINDOW) // STEP)) if n else -1
    return [(i * STEP, min(i * STEP + WINDOW, n)) for i in range(last + 1)]


def _numbers(words: list[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    return np.fromiter(map(vocabulary.get, words, repeat(len(vocabulary))), np.int64, len(words))


def _windows(lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: text, begin and end of every window."""
    n = np.array(lengths, np.int64)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STEP)), 0)
    text = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    starts = np.cumsum(n) - n
    begin = starts[text] + place * STEP
    return text, begin, np.minimum(begin + WINDOW, starts[text] + n[text])


def _entries(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each window inside the vocabulary, with their counts: window, word, count."""
    size = end - begin
    row = np.repeat(np.arange(len(begin)), size)
    flat = ids[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(len(row))]
    inside = flat < none
    key, count = np.unique(row[inside] * none + flat[inside], return_counts=True) if none else (np.zeros(0, np.int64),) * 2
    return key // max(none, 1), key % max(none, 1), count


def count_words(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many passages of ``docs`` (doc_id, text) each word occurs, and how many passages there are."""
    none = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(none + 1, np.int64)
        for batch in parts_of(batches):
            for text in batch.column(0).to_pylist():
                ids = _numbers(words_of(text), vocabulary)
                # passages side by side, not overlapping
                passage = np.arange(len(ids)) // WINDOW
                inside = ids < none
                np.add.at(counts, np.unique(passage[inside] * none + ids[inside]) % max(none, 1), 1)
                counts[none] += -(-len(ids) // WINDOW)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["word", "n"])

    sums = docs.select(text_of("text").alias("text")).mapInArrow(tidy(run), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = np.zeros(none + 1, np.int64)
    for r in sums.collect():  # at most the vocabulary of a block
        counts[r["word"]] = r["n"]
    return counts[:none], int(counts[none])


def _rows(items: DataFrame, vocabulary: dict[bytes, int], weights: np.ndarray):
    """A mapper of benchmark rows (item, text) to sparse unit rows of passages."""

    def passages(batch: pa.RecordBatch):
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = _numbers(words_of(text), vocabulary)
            for begin, end in spots(len(ids)):
                word, count = np.unique(ids[begin:end], return_counts=True)
                value = count * weights[word]
                yield item, begin, word, value / np.linalg.norm(value)

    return passages


def _gauss(word: np.ndarray, size: int) -> np.ndarray:
    """Rows of a seeded normal matrix, each made from the word's number alone."""
    return np.stack([np.random.Generator(np.random.PCG64([SEED, int(w)])).standard_normal(size) for w in word]) if len(word) else np.zeros((0, size))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of equal length as rows."""
    parts = [c.flatten().to_numpy() for c in column.chunks]
    return np.concatenate(parts).reshape(-1, width) if parts else np.zeros((0, width))


def randomised_svd(items: DataFrame, vocabulary: dict[bytes, int], weights: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Axes [word, axis] of the leading right singular vectors of the passages of ``items`` (item, text).

    Two passes over the rows: the first sums the Gram matrix of their random projections, the second the projection of
    the rows on its orthonormal base. Sums are of fixed size (rank squared, or words by rank).
    """
    passages = _rows(items, vocabulary, weights)
    size = rank + OVERSAMPLING

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            projected = [value @ _gauss(word, size) for _, _, word, value in passages(batch)]
            if projected:
                y = np.stack(projected)
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(list(total), pa.list_(pa.float64()))], names=["row", "sums"])

    def added(df: DataFrame, key: str, count: int, width: int) -> np.ndarray:
        """Arrays of equal keys added up, as rows of a matrix."""

        def total(part: pa.Table) -> pa.Table:
            keys, where = np.unique(part.column(key).to_numpy(), return_inverse=True)
            sums = np.zeros((len(keys), width))
            np.add.at(sums, where, _matrix(part.column("sums"), width))
            return pa.table({key: keys, "sums": pa.array(list(sums), pa.list_(pa.float64()))})

        found = df.groupBy(F.pmod(key, F.lit(SUM_GROUPS))).applyInArrow(total, f"{key} long, sums array<double>").toArrow()
        out = np.zeros((count, width))
        out[found.column(key).to_numpy()] = _matrix(found.column("sums"), width)
        return out

    total = added(items.mapInArrow(gram, "row long, sums array<double>"), "row", size, size)
    values, base = np.linalg.eigh(total)
    good = values > 1e-9 * max(values.max(), 1e-300)
    whiten = base[:, good] / np.sqrt(values[good])  # Y @ whiten has orthonormal columns

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, _, word, value in passages(batch):
                q = (value @ _gauss(word, size)) @ whiten
                for w, v in zip(word.tolist(), value):
                    sums[w] = sums.get(w, 0.0) + v * q
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["word", "sums"])

    width = int(good.sum())
    if not width:
        return np.zeros((len(vocabulary), 1))
    b = added(items.mapInArrow(project, "word long, sums array<double>"), "word", len(vocabulary), width)
    values, base = np.linalg.eigh(b.T @ b)
    top = np.argsort(values)[::-1][:rank]
    top = top[values[top] > 1e-12]
    return b @ base[:, top] / np.sqrt(values[top])


def build_space(docs: DataFrame, items: DataFrame) -> Space:
    """The space of a block of benchmark texts: ``items`` (item, item_id, text), item from 0."""
    given = items.select("item", "item_id", "text").orderBy("item").collect()  # at most BLOCK_ITEMS
    split = [words_of(r["text"]) for r in given]
    vocabulary = {w: i for i, w in enumerate(sorted({w for ws in split for w in ws}))}
    counts, passages = count_words(docs, vocabulary)
    weights = np.append(np.log((passages + 2) / (counts + 1)), math.log(passages + 2))
    latents = []
    for pieces in pieces_of(split):
        own = {w: i for i, w in enumerate(sorted({w for _, ws in pieces for w in ws}))}
        words = _numbers(list(own), vocabulary)  # both sorted alike
        rows = [(i, b" ".join(ws).decode("utf-8", "surrogatepass")) for i, ws in pieces]
        part = kept(docs.sparkSession.createDataFrame(rows, "item long, text string").repartition(8), "benchmark-passages")
        latents.append(_latent(pieces, own, words, weights[words], randomised_svd(part, own, weights[words])))
    listed = [Item(r["item_id"], _numbers(ws, vocabulary), answer_of(r["text"])) for r, ws in zip(given, split)]
    return Space(vocabulary, listed, weights, latents)


def pieces_of(texts: list[list[bytes]]) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Groups of (text, words) with at most RANK passages each; a text of more passages is cut between them."""
    group, size = [], 0
    for i, words in enumerate(texts):
        n = len(spots(len(words)))
        for at in range(0, n, RANK):
            more = min(RANK, n - at)
            if size + more > RANK:
                yield group
                group, size = [], 0
            group.append((i, words[at * STEP : (at + more - 1) * STEP + WINDOW]))
            size += more
    if group:
        yield group


def _latent(pieces: list[tuple[int, list[bytes]]], own: dict[bytes, int], words: np.ndarray, weights: np.ndarray, axes: np.ndarray) -> Latent:
    found, owner = [], []
    for i, ws in pieces:
        ids = _numbers(ws, own)
        for begin, end in spots(len(ids)):
            word, count = np.unique(ids[begin:end], return_counts=True)
            found.append((count * weights[word]) @ axes[word])
            owner.append(i)
    latent = np.stack(found)
    norms = np.maximum(np.linalg.norm(latent, axis=1), 1e-12).astype(np.float32)
    latent, axes = (latent / norms[:, None]).astype(np.float32), axes.astype(np.float32)
    adds = axes @ latent.T
    return Latent(words, axes, latent, norms, np.array(owner, np.int64), np.maximum(adds.max(axis=1), 0), np.maximum((adds / norms).max(axis=1), 0))


def candidates(space: Space, ids: np.ndarray, lengths: list[int]) -> list[tuple[int, int, int, int, float]]:
    """Windows like a benchmark passage: (text, begin, end, item, cosine), begin and end in the texts laid end to end."""
    none = len(space.vocabulary)
    text, begin, end = _windows(lengths)
    if not len(text) or not space.latents:
        return []
    row, word, count = _entries(ids, begin, end, none)
    value = count * space.weights[word]
    inner = np.bincount(row, value**2, len(text))
    others = (end - begin) - np.bincount(row, count, len(text))
    norm = np.sqrt(np.maximum(inner + others * space.weights[none] ** 2, 1e-24))
    found = []
    for latent in space.latents:
        number = np.full(none, -1)
        number[latent.words] = np.arange(len(latent.words))
        use = number[word] >= 0
        found += [(int(text[w]), int(begin[w]), int(end[w]), *rest) for w, *rest in _like(latent, row[use], number[word[use]], value[use], norm)]
    return found


def _like(latent: Latent, row: np.ndarray, word: np.ndarray, value: np.ndarray, norm: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """(window, item, cosine) of windows like a passage of one space, from their entries in its words."""
    n = len(norm)
    left = np.bincount(row, value * latent.gain[word], n) >= (SIMILARITY - 1e-3) * norm
    left |= np.bincount(row, value * latent.cover[word], n) >= COVERED - 1e-3
    window, number = np.flatnonzero(left), np.cumsum(left) - 1
    use = left[row]
    row, word, value = number[row[use]], word[use], value[use].astype(np.float32)
    edges = np.searchsorted(row, np.arange(len(window) + 1))
    for at in range(0, len(window), 2048):
        stop = min(at + 2048, len(window))
        a, b = edges[at], edges[stop]
        if b == a:
            continue
        folded = np.zeros((stop - at, latent.axes.shape[1]), np.float32)
        here, first = np.unique(row[a:b], return_index=True)
        folded[here - at] = np.add.reduceat(latent.axes[word[a:b]] * value[a:b, None], first, axis=0)
        inner = folded @ latent.passages.T
        cosine = inner / norm[window[at:stop], None]
        for i, j in zip(*np.nonzero((cosine >= SIMILARITY) | (inner >= COVERED * latent.norms))):
            yield int(window[at + i]), int(latent.owner[j]), float(cosine[i, j])


def common_weight(item: np.ndarray, region: np.ndarray, weights: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of two word sequences."""
    best = np.zeros(len(region) + 1)
    for w in item.tolist():
        better = np.where(region == w, best[:-1] + weights[w], 0.0)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], better))
    return float(best[-1])


def confirm(space: Space, ids: np.ndarray, lengths: list[int]) -> list[tuple[int, int, int, float, float, float]]:
    """Confirmed candidates: (text, item, first word, cosine, share of the text, share of its answer), one per pair."""
    starts = np.cumsum([0, *lengths])
    regions: dict[tuple[int, int], list] = {}
    for text, begin, end, item, cosine in sorted(candidates(space, ids, lengths)):
        spread = len(space.items[item].words)
        a, b = max(begin - spread, int(starts[text])), min(end + spread, int(starts[text + 1]))
        known = regions.setdefault((text, item), [])
        if known and begin <= known[-1][2]:  # windows that touch are one region
            known[-1][1], known[-1][2], known[-1][3] = max(b, known[-1][1]), max(end, known[-1][2]), max(cosine, known[-1][3])
        else:
            known.append([a, b, end, cosine])
    out = []
    for (text, item), known in regions.items():
        one, best = space.items[item], None
        total = space.weights[one.words].sum()
        answer = one.words[len(one.words) - one.answer :]
        answer_total = space.weights[answer].sum()
        for a, b, _, cosine in known:
            # a region of many windows is read in parts that overlap by two texts
            stride = 8 * len(one.words) + 4 * WINDOW
            for s in range(a, max(b - 2 * len(one.words), a + 1), stride):
                region = ids[s : min(b, s + stride + 2 * len(one.words))]
                share = common_weight(one.words, region, space.weights) / max(total, 1e-12)
                if share < REWORDED or (best and share <= best[4]):
                    continue
                said = common_weight(answer, region, space.weights) / max(answer_total, 1e-12)
                if share >= COPIED or said >= ANSWERED:
                    best = (text, item, s - int(starts[text]), cosine, share, said)
        if best:
            out.append(best)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents of ``docs`` (doc_id, text) that hold a text of ``benchmark`` (item_id, text).

    Returns doc_id, item_id, first_word (a word of the document where the copy is near), similarity (cosine of the
    candidate), text_share and answer_share (of the weight, in common subsequences), one row for each document row and
    benchmark row. Null and empty texts hold nothing and are held by nothing. Rows without ids are searched like others;
    repeated rows give repeated results. Further columns are ignored; empty tables give no rows.
    """
    spark = docs.sparkSession
    listed = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of("text").alias("text"))
    listed = kept(listed.select(F.xxhash64("item_id", "text").alias("h"), "item_id", "text"), "benchmark")
    n = listed.count()
    blocks = -(-n // BLOCK_ITEMS)
    corpus = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    schema = "doc_id long, item_id long, first_word long, similarity double, text_share double, answer_share double"
    found = spark.createDataFrame([], schema)
    for k in range(blocks):
        part = listed.where(F.pmod("h", F.lit(blocks)) == k).orderBy("h", "item_id")
        items = [(i, r["item_id"], r["text"]) for i, r in enumerate(part.select("item_id", "text").collect())]
        if items:
            block = kept(spark.createDataFrame(items, "item long, item_id long, text string").repartition(8, "item"), "benchmark-block")
            space = build_space(corpus, block)
            found = found.union(corpus.mapInArrow(tidy(_finder(space)), schema))
    return found


def _finder(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            out, docs, ids, lengths = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(_numbers(words_of(text), space.vocabulary))
                docs.append(doc)
                lengths.append(len(ids[-1]))
                if sum(lengths) > CHUNK_WORDS:
                    out += [(docs[t], space.items[i].item_id, *rest) for t, i, *rest in confirm(space, np.concatenate(ids), lengths)]
                    docs, ids, lengths = [], [], []
            if docs:
                out += [(docs[t], space.items[i].item_id, *rest) for t, i, *rest in confirm(space, np.concatenate(ids), lengths)]
            columns = list(zip(*out)) if out else [()] * 6
            types = [pa.int64()] * 3 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "item_id", "first_word", "similarity", "text_share", "answer_share"])

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark text; all columns stay. Rows without doc_id stay."""
    mark = fresh(docs, "held_doc")
    held = contaminated(docs, benchmark).where("doc_id IS NOT NULL").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(held, docs["doc_id"].cast("long") == held[mark], "left_anti")
