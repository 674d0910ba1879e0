"""Quality of documents by histogram gradient-boosted trees over statistics of their texts.

Statistics (see ``NAMES``) are of a whole text alone: shares of kinds of characters, forms of words, repetition of
words, pairs and lines, lengths, and how well it compresses. Each is cut into at most ``BINS`` bins by quantiles of the
training rows. Trees of depth ``DEPTH`` are grown level by level: one histogram of gradients over (node, statistic, bin)
gives every node its best cut, so a level costs one pass over the binned rows. A model is three arrays, cut statistics,
cut values and leaf values of complete trees, and a batch of documents walks all trees at once in numpy.

Training reads at most ``SAMPLE_DOCUMENTS`` labelled documents, those of the smallest hashes of their ids; equal texts
with equal labels count once. All documents are scored.

Defined cases: null and empty texts have statistics of zero and a score like all others; a document labelled both ways
counts as 0; null labels and labels without a document are not read; without any label every score is 0.5. Repeated
rows are scored alike. Texts are read in parts of a megabyte.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolode.llm.common import Batches, byte_chunks, fresh, parts_of, text_of, tidy

#: Bound of the rows that training reads, on the driver.
SAMPLE_DOCUMENTS = 20_000
BINS = 64
DEPTH = 4
TREES = 150
RATE = 0.1
#: Least weight of a leaf, and what is added to it against chance.
LEAST_WEIGHT = 1.0
SMOOTH = 2.0

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t\r\x0b\x0c",
    "newline": b"\n",
    "stop": b".!?",
    "exclaim": b"!",
    "pause": b",;:",
    "quote": b"\"'()-",
    "mark": b"#$%&*+/<=>@[\\]^_`{|}~",
    "bar": b"|",
    "control": bytes([*range(9), *range(14, 32), 127]),
}
NAMES = [
    "log_bytes",
    *_CLASSES,
    "wide",
    "bits",
    "packed",
    "log_words",
    "word_chars",
    "word_spread",
    "longest_word",
    "short_words",
    "shouted_words",
    "capital_words",
    "plain_words",
    "marked_words",
    "kinds",
    "top_word",
    "stutter",
    "kinds_of_pairs",
    "words_a_stop",
    "log_lines",
    "line_words",
    "kinds_of_lines",
    "ended_lines",
    "blank_lines",
]

#: Forms of a word, of which the first that fits counts; the classes cover the letters of Latin-1.
_FORM = re.compile(
    r"""[^\w]*[A-ZÀ-ÖØ-Þ]{2,}\W*()$            # shouted
    |[^\w]?[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]*[.,;:!?"')]?()$  # capital
    |["'(]?[a-zß-öø-ÿ]+[.,;:!?"')]?()$        # plain
    |[^\W_]+[^\w\s]{2,}()$                    # marked
    """,
    re.VERBOSE,
)


def _alike(char: str) -> str:
    """A character that the forms treat like ``char``."""
    if char.isspace():
        return " "
    if re.match("[A-ZÀ-ÖØ-Þ]", char):
        return "A"
    if re.match("[a-zß-öø-ÿ]", char):
        return "a"
    if char.isalnum():
        return "0"
    if char in "\"'":
        return "'"
    if char in ".,;:!?)":
        return "."
    return char if char in "_(" else "-"


#: Forms remembered by a worker, of shapes up to a length.
KNOWN_SHAPES = 1 << 14
KNOWN_CHARS = 64
_ALIKE = bytes(ord(_alike(chr(i))) for i in range(256))


def shapes(text: str) -> list[str]:
    """The words of a text, in Latin-1 with like characters made equal: same lengths and forms, but few kinds."""
    try:
        return text.encode("latin-1").translate(_ALIKE).decode("ascii").split()
    except UnicodeEncodeError:
        return text.split()


def _form(word: str) -> int:
    """Which of the forms a word has, 0 for none."""
    fit = _FORM.match(word)
    return fit.lastindex if fit else 0


_known_form = lru_cache(KNOWN_SHAPES)(_form)


def _counted(text: bytes) -> tuple[int, ...]:
    """What is counted in one whole text, in the order of ``_COUNTED``."""
    words: Counter[str] = Counter()
    shaped: Counter[str] = Counter()
    pairs: set[int] = set()
    lines: set[int] = set()
    stutter = n_lines = blank_lines = ended = packed = 0
    last = ""
    for part in byte_chunks(text):
        packed += len(zlib.compress(part, 1))
        decoded = part.decode()
        found = decoded.split()
        words.update(found)
        shaped.update(shapes(decoded))
        before = [last, *found]
        stutter += sum(map(eq, before, found))
        pairs.update(map(hash, zip(before, found)))
        last = found[-1] if found else last
    for line in text.split(b"\n"):
        line = line.strip()
        if line:
            lines.add(zlib.crc32(line))
            n_lines += 1
            ended += line[-1:] in b".!?\"'"
        else:
            blank_lines += 1

    forms = [0] * 5
    n = chars = squares = longest = short = 0
    for word, k in shaped.items():
        size = len(word)
        n += k
        chars += k * size
        squares += k * size * size
        longest = max(longest, size)
        short += k if size <= 3 else 0
        forms[_known_form(word) if size <= KNOWN_CHARS else _form(word)] += k
    if not n:  # a text without words counts as one word without letters
        n = short = top = 1
    else:
        top = max(words.values())
    return len(text), packed, n, chars, squares, longest, short, *forms[1:], len(words), top, stutter, len(pairs), n_lines, len(lines), ended, blank_lines


_COUNTED = (
    "bytes packed words chars squares longest short shouted capital plain marked kinds top stutter pairs lines kinds_of_lines ended blank"
).split()


def statistics(text: bytes) -> list[float]:
    """The statistics of one whole text in UTF-8, in the order of ``NAMES``."""
    return statistics_of([text])[0].tolist()


def statistics_of(texts: list[bytes]) -> np.ndarray:
    """A row of statistics for each text; what is counted text by text is turned into shares for all at once."""
    out = np.zeros((len(texts), len(NAMES)))
    given = [i for i, text in enumerate(texts) if text]
    if not given:
        return out
    counts = np.stack([np.bincount(np.frombuffer(texts[i], np.uint8), minlength=256) for i in given]).astype(float)
    c = dict(zip(_COUNTED, np.array([_counted(texts[i]) for i in given], float).T))
    size, n, n_lines = c["bytes"], c["words"], np.maximum(c["lines"], 1)
    share = counts / size[:, None]
    mean = c["chars"] / n
    found = [
        np.log1p(size),
        *(counts[:, list(chars)].sum(1) / size for chars in _CLASSES.values()),
        counts[:, 0xC0:].sum(1) / (size - counts[:, 0x80:0xC0].sum(1)),  # first bytes of code points beyond ASCII
        -(share * np.log2(np.where(share > 0, share, 1))).sum(1),
        c["packed"] / size,
        np.log1p(n),
        mean,
        np.sqrt(np.maximum(0, c["squares"] / n - mean**2)),
        np.log1p(c["longest"]),
        c["short"] / n,
        *(c[form] / n for form in ("shouted", "capital", "plain", "marked")),
        c["kinds"] / n,
        c["top"] / n,
        c["stutter"] / n,
        c["pairs"] / n,
        n / (1 + counts[:, list(b".!?")].sum(1)),
        np.log1p(n_lines),
        n / n_lines,
        c["kinds_of_lines"] / n_lines,
        c["ended"] / n_lines,
        c["blank"] / (n_lines + c["blank"]),
    ]
    out[given] = np.stack(found, 1)
    return out


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: node i has children 2i + 1 and 2i + 2, and a row goes right where it exceeds the cut."""

    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, leaves)
    base: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        if not len(self.feature):
            return np.full(len(rows), _chance(np.float64(self.base)))
        trees, at = np.arange(len(self.feature)), np.zeros((len(rows), len(self.feature)), np.int64)
        for _ in range(DEPTH):
            right = np.take_along_axis(rows, self.feature[trees, at], 1) > self.cut[trees, at]
            at = 2 * at + 1 + right
        return _chance(self.base + self.leaf[trees, at - self.feature.shape[1]].sum(1))


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _cuts(column: np.ndarray) -> np.ndarray:
    """Values that part a statistic into at most BINS bins of about as many rows, between values that occur."""
    kinds = np.unique(column)
    middles = (kinds[1:] + kinds[:-1]) / 2
    if len(middles) < BINS:
        return middles
    ranks = np.searchsorted(np.sort(column), middles)
    return np.unique(middles[np.searchsorted(ranks, np.linspace(0, len(column), BINS + 1)[1:-1]).clip(0, len(middles) - 1)])


def grow(rows: np.ndarray, labels: np.ndarray, trees: int = TREES) -> Trees:
    """Boosted trees of the logistic loss; the same rows in the same order give the same trees."""
    n, width = rows.shape
    base = float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    cuts = [_cuts(rows[:, f]) for f in range(width)]
    binned = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], 1)
    cell = binned + np.arange(width) * BINS  # row, statistic -> place in a node's histogram
    inner = 2**DEPTH - 1
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    margin = np.full(n, base)
    for t in range(trees):
        p = _chance(margin)
        pull, weight = labels - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(DEPTH):
            nodes = 2**level
            place = (node[:, None] * (width * BINS) + cell).ravel()
            g, h = (np.bincount(place, np.repeat(x, width), nodes * width * BINS).reshape(nodes, width, BINS) for x in (pull, weight))
            g_left, h_left = g.cumsum(2), h.cumsum(2)
            g_all, h_all = g_left[:, :1, -1:], h_left[:, :1, -1:]
            g_right, h_right = g_all - g_left, h_all - h_left
            gain = g_left**2 / (h_left + SMOOTH) + g_right**2 / (h_right + SMOOTH) - g_all**2 / (h_all + SMOOTH)
            gain[(h_left < LEAST_WEIGHT) | (h_right < LEAST_WEIGHT)] = 0
            for f, c in enumerate(cuts):
                gain[:, f, len(c) :] = 0  # behind the last cut
            best = gain.reshape(nodes, -1).argmax(1)
            for k in range(nodes):
                f, b = divmod(int(best[k]), BINS)
                if gain[k, f, b] > 1e-9:
                    feature[t, nodes - 1 + k], cut[t, nodes - 1 + k] = f, cuts[f][b]
            mine = nodes - 1 + node
            node = 2 * node + (rows[np.arange(n), feature[t, mine]] > cut[t, mine])
        g, h = np.bincount(node, pull, inner + 1), np.bincount(node, weight, inner + 1)
        leaf[t] = RATE * g / (h + SMOOTH)
        margin += leaf[t][node]
    return Trees(feature, cut, leaf, base)


def _texts(batches: Batches):
    """Slices of few rows, each with its texts as bytes; the first column is the text."""
    for batch in parts_of(batches):
        yield batch, [t.as_buffer().to_pybytes() for t in batch.column(0)]


def held_out(doc_id: Column) -> Column:
    """Whether no label of the document may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Trees:
    """Trees of at most ``sample`` labelled documents of ``docs`` (doc_id, text) and ``labels`` (doc_id, quality)."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # bounded, so it may be broadcast
    rows = docs.select(text_of("text").alias("text"), "doc_id").join(F.broadcast(drawn), "doc_id").select("text", "doc_id", "quality", F.xxhash64("text").alias("copy"))

    def run(batches: Batches) -> Batches:
        for batch, texts in _texts(batches):
            found = pa.array(list(statistics_of(texts)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], found], names=["doc_id", "quality", "copy", "row"])

    read = rows.mapInArrow(tidy(run), "doc_id long, quality int, copy long, row array<double>")
    # documents that share an id may be many, so the bound is set again
    read = read.orderBy(F.xxhash64("doc_id"), "doc_id", "copy").limit(sample).toArrow()
    if not len(read):
        return Trees(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), 0.0)
    label = read.column("quality").to_numpy() > 0
    keys = np.stack([read.column("copy").to_numpy(), label], 1)
    first = np.sort(np.unique(keys, axis=0, return_index=True)[1])
    values = np.array(read.column("row").to_pylist())
    return grow(values[first], label[first].astype(float))


def score_documents(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with a column ``quality`` (0 to 1), named longer where it is taken."""
    # mapInArrow reads columns by name, dots as paths; so they are numbered meanwhile
    read = docs.select(text_of("text"), *(F.col(f"`{c}`") for c in docs.columns)).toDF(*(f"c{i}" for i in range(len(docs.columns) + 1)))
    schema = T.StructType([*read.schema.fields[1:], T.StructField("score", T.DoubleType())])

    def run(batches: Batches) -> Batches:
        for batch, texts in _texts(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(trees.scores(statistics_of(texts)))], names=schema.names)

    return read.mapInArrow(tidy(run), schema).toDF(*docs.columns, fresh(docs, "quality"))
