"""Cross-entropy difference between a target and a background language model.

Both models are bigram models over one vocabulary, the most frequent words of all documents, with the same smoothing. The
target model counts the documents that a label marks, the background model all others; background counts are scaled to
the size of the target, so both know as much and no document is left out. A document's score is its mean loss per token
under the target less that under the background: the lower, the more it is like the target. A document's own counts
are taken out of its model before it is scored, so none vouches for itself.

Every pair of numbers has counts of its own. No task holds them all: a chunk of documents sends its pairs and their counts to
the parts of a hash range, each part adds up its own pairs and answers every chunk with the sums of what it asked for,
and a chunk is scored with the answers of all parts. On the way numbers are written by bytes of equal weight and deflated.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolode.llm.common import kept, parts_of, text_of, tidy

#: Words of the vocabulary (fewer than 65,534, so that numbers fit in two bytes), and what stands before a text's first.
VOCABULARY = 32_000
START = 65_535
#: Weight of the unigram model in tokens.
PRIOR = 20.0
COUNTER_WORDS = 400_000
#: Tokens (and documents) of a chunk, and tokens whose pairs a part adds up.
CHUNK_TOKENS = 500_000
PART_TOKENS = 4_000_000

_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def tokens_of(text: str) -> list[bytes]:
    """Words and single ASCII marks of a text in lower case."""
    data = text.lower().encode("utf-8", "surrogatepass")
    for mark in set(_MARKS).intersection(data):
        one = bytes([mark])
        data = data.replace(one, b" " + one + b" ")
    return data.split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(counter: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], names=["word", "n"])

    counter: Counter = Counter()
    for batch in parts_of(batches):
        for text in batch.column(0).to_pylist():
            counter.update(tokens_of(text))
            if len(counter) > COUNTER_WORDS:
                yield out(counter)
                counter = Counter()
    yield out(counter)


def vocabulary_of(docs: DataFrame, size: int = VOCABULARY) -> dict[bytes, int]:
    """Numbers from 1 of the most frequent words; 0 stands for all others.

    The driver is sent the words of the counts that reach that far, not the most frequent ones of each partition.
    """
    counts = docs.select(text_of("text").alias("text")).mapInArrow(tidy(_count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = kept(counts, "words")
    # one row per count that occurs
    above = F.sum("words").over(Window.orderBy(F.desc("n")))
    least = counts.groupBy("n").agg(F.count("*").alias("words")).withColumn("above", above).where(F.col("above") >= size).agg(F.max("n")).first()[0]
    frequent = counts.where(F.col("n") >= (least or 0))
    return {bytes(r["word"]): i + 1 for i, r in enumerate(frequent.orderBy(F.desc("n"), "word").limit(size).collect())}


def packed(values: np.ndarray) -> bytes:
    """Numbers of one kind, all their first bytes before their second ones, deflated."""
    return zlib.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def slots_of(before: np.ndarray, word: np.ndarray, slots: int) -> np.ndarray:
    """Hashed slot of each pair of numbers."""
    x = (before.astype(np.uint64) << np.uint64(20) | word.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - slots.bit_length() + 1)).astype(np.int64)


def pairs_of(before: np.ndarray, word: np.ndarray, slots: int | None = None) -> np.ndarray:
    """A number below 2^32 of each pair, its own, or one per slot if slots are given; they spread evenly."""
    key = slots_of(before, word, slots) if slots else before << 16 | word
    return key * 0x9E3779B1 & 0xFFFFFFFF  # an odd factor keeps different ones different


def numbered(docs: DataFrame, targets: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Rows (doc_id, ids, target): the packed numbers of a document's tokens in two bytes each, and whether it is in ``targets``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            found = []
            for text in batch.column(1).to_pylist():
                tokens = tokens_of(text)
                found.append(packed(np.fromiter(map(vocabulary.get, tokens, repeat(0)), "<u2", len(tokens))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(tidy(run), "doc_id long, ids binary")
    marked = targets.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("target", F.lit(1))
    # labels grow with the documents, so that the join is the same for any input
    return rows.join(marked.hint("merge"), "doc_id", "left").select("doc_id", "ids", F.coalesce("target", F.lit(0)).alias("target"))


def chunked(rows: DataFrame) -> DataFrame:
    """Documents in groups of about CHUNK_TOKENS tokens: chunk, doc_ids, lengths, targets, and ids, packed end to end."""
    schema = "chunk long, doc_ids array<long>, lengths array<long>, targets array<int>, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def out() -> pa.RecordBatch:
            docs, ids, targets = zip(*held)
            lists = [pa.array([x], pa.list_(kind)) for x, kind in ((docs, pa.int64()), ([len(i) for i in ids], pa.int64()), (targets, pa.int32()))]
            columns = [pa.array([number], pa.int64()), *lists, pa.array([packed(np.concatenate(ids))], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "doc_ids", "lengths", "targets", "ids"])

        for part in parts_of(batches):
            for doc, data, target in zip(*(c.to_pylist() for c in part.columns)):
                ids = unpacked(data, "<u2")
                if held and (size + len(ids) > CHUNK_TOKENS or len(held) >= CHUNK_TOKENS):
                    yield out()
                    number, held, size = number + 1, [], 0
                held.append((doc, ids, target))
                size += len(ids)
        if held:
            yield out()

    return rows.select("doc_id", "ids", "target").mapInArrow(tidy(run), schema)


@dataclass
class Chunk:
    """Documents of a chunk, and for all their tokens the number, the one before, and whether the document is a target."""

    number: int
    docs: list
    lengths: np.ndarray
    targets: np.ndarray
    word: np.ndarray
    before: np.ndarray

    @property
    def of(self) -> np.ndarray:
        return np.repeat(self.targets, self.lengths)


def _chunks(batch: pa.RecordBatch | pa.Table) -> Iterator[Chunk]:
    for i in range(len(batch)):
        number, docs, lengths, targets, ids = (batch.column(c)[i].as_py() for c in ("chunk", "doc_ids", "lengths", "targets", "ids"))
        lengths, word = np.array(lengths, np.int64), unpacked(ids, "<u2").astype(np.int64)
        before = np.concatenate([[START], word])[:-1]
        before[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
        yield Chunk(number, docs, lengths, np.array(targets, np.int64), word, before)


@dataclass
class Counts:
    """Counts of one model: of words, and of words as the first of a pair."""

    words: np.ndarray
    firsts: np.ndarray

    @property
    def total(self) -> float:
        return float(self.words.sum())


def count_models(chunks: DataFrame) -> tuple[Counts, Counts]:
    """Target and background counts of words; as many numbers for any input."""
    width = 65_536

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 2 * width), np.int64)
        for batch in batches:
            for c in _chunks(batch):
                for offset, values in ((0, c.word), (width, c.before)):
                    sums += np.bincount(2 * width * c.of + offset + values, minlength=4 * width).reshape(2, -1)
        p = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(sums[1, p]), pa.array(sums[0, p])], names=["place", "target", "background"])

    added = chunks.mapInArrow(tidy(run), "place long, target long, background long").groupBy("place").agg(F.sum("target").alias("target"), F.sum("background").alias("background"))
    table = added.toArrow()
    place, found = table.column("place").to_numpy(), []
    for name in ("target", "background"):
        sums = np.zeros(2 * width)
        sums[place] = table.column(name).to_numpy()
        found.append(Counts(sums[:width], sums[width:]))
    return found[0], found[1]


def count_pairs(chunks: DataFrame, parts: int, slots: int | None = None) -> DataFrame:
    """Per chunk and part of the hash range: counts in all documents, target and background, of the chunk's pairs in order."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in _chunks(batch):
                found, where = np.unique(pairs_of(c.before, c.word, slots), return_inverse=True)
                both = np.bincount(where, minlength=len(found))
                target = np.bincount(where, c.of, len(found)).astype(np.int64)
                edges = np.searchsorted(found, (np.arange(parts + 1) << 32) // parts)
                rows = []
                for part in np.flatnonzero(np.diff(edges)):
                    at = slice(edges[part], edges[part + 1])
                    steps = np.diff(found[at], prepend=0)
                    rows.append((c.number, part, *(packed(x.astype("<u4")) for x in (steps, target[at], (both - target)[at]))))
                if rows:
                    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=["chunk", "part", "pairs", "target", "background"])

    def answer(asked: pa.Table) -> pa.Table:
        pairs = [np.cumsum(unpacked(b, "<u4"), dtype=np.int64) for b in asked.column("pairs").to_pylist()]
        ends = np.cumsum([len(p) for p in pairs])[:-1]
        found, where = np.unique(np.concatenate(pairs), return_inverse=True)
        out = {"chunk": asked.column("chunk"), "part": asked.column("part")}
        for name in ("target", "background"):
            own = np.concatenate([unpacked(b, "<u4") for b in asked.column(name).to_pylist()])
            sums = np.bincount(where, own, len(found)).astype("<i8")[where]
            out[name] = pa.array([packed(x) for x in np.split(sums, ends)], pa.binary())
        return pa.table(out)

    asked = chunks.mapInArrow(tidy(ask), "chunk long, part int, pairs binary, target binary, background binary")
    return asked.groupBy("part").applyInArrow(answer, "chunk long, part int, target binary, background binary")


def losses(model: Counts, scale: float, kinds: int, word: np.ndarray, before: np.ndarray, pairs: np.ndarray, own: tuple) -> np.ndarray:
    """Loss in bits of each token, with the given own counts taken out before counts are scaled."""
    c_word, c_first, c_pair = (np.maximum(c - o, 0) * scale for c, o in zip((model.words[word], model.firsts[before], pairs), own[:3]))
    total = max(model.total * scale, 0) - own[3] * scale
    single = (c_word + 1) / (np.maximum(total, 0) + kinds)
    pair = np.minimum(np.minimum(c_pair, c_word), c_first)
    return -np.log2((pair + PRIOR * single) / (c_first + PRIOR))


def _own(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """How often each value occurs in its document, at each token."""
    _, where, counts = np.unique(doc * (1 << 32) + value, return_inverse=True, return_counts=True)
    return counts[where]


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, size: int = VOCABULARY, slots: int | None = None) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text), where ``targets`` (doc_id) names the target documents.

    Returns doc_id, target (boolean), n_tokens, target_loss and background_loss (bits per token) and difference (the
    first less the second). Null and empty texts have no tokens and zeros. Rows without doc_id belong to the background;
    rows that share a doc_id are documents of their own in the same model. If a model has no documents it is uniform.
    Further columns are ignored; an empty table gives no rows. Pairs are counted exactly, or in so many hashed ``slots``
    if a number is given; a slot's count is never taken for more than those of its two words.
    """
    vocabulary = vocabulary_of(docs, size)
    chunks = kept(chunked(numbered(docs, targets, vocabulary)), "chunks")
    target, background = count_models(chunks)
    scale = target.total / background.total if target.total and background.total else 1.0
    kinds = len(vocabulary) + 1
    parts = 1 + int(target.total + background.total) // PART_TOKENS

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        (c,) = _chunks(chunk)
        doc = np.repeat(np.arange(len(c.docs)), c.lengths)
        pair, sums = pairs_of(c.before, c.word, slots), []
        own = [_own(doc, x) for x in (c.word, c.before, pair)] + [c.lengths[doc]]
        where, order = np.unique(pair, return_inverse=True)[1], np.argsort(answers.column("part").to_numpy())
        for model, factor, mark, name in ((target, 1.0, 1, "target"), (background, scale, 0, "background")):
            counts = [unpacked(answers.column(name)[i].as_py(), "<i8") for i in order]
            counts = np.concatenate(counts)[where] if counts else np.zeros(0)
            mine = [x * (c.of == mark) for x in own]
            sums.append(np.bincount(doc, losses(model, factor, kinds, c.word, c.before, counts, mine), len(c.docs)) / np.maximum(c.lengths, 1))
        columns = [pa.array(c.docs, pa.int64()), pa.array(c.targets == 1), pa.array(c.lengths), pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[0] - sums[1])]
        return pa.table(columns, names=["doc_id", "target", "n_tokens", "target_loss", "background_loss", "difference"])

    schema = "doc_id long, target boolean, n_tokens long, target_loss double, background_loss double, difference double"
    return chunks.groupBy("chunk").cogroup(count_pairs(chunks, parts, slots).groupBy("chunk")).applyInArrow(run, schema)
