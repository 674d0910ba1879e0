"""Toxic spans by a linear-chain conditional random field.

Labels say which documents are toxic, not which words, so token labels are made first: a word form (whole word, prefix
or suffix) that occurs in toxic documents beyond what shuffled labels could show marks the tokens of toxic documents
that have it. The field has two states, weights for the forms of a token and for changes of state, and is trained on
chains of such tokens by gradient ascent. Forward-backward marginals of all tokens of a document then give its score (by
a logistic curve over their largest and their sum, fitted on the training documents) and the offending spans.

A chain is a line of a text, in runs of ``CHAIN`` tokens at most. Tokens are what stands between white space; their
forms are read in lower case without the characters around letters and digits. A token of several words joined by other
characters has the forms of each, and a word of more than ``LONG_WORD`` letters (scripts without spaces, junk) those of all
its pieces of ``PIECES`` letters, so every part of a text is read. Only texts enter a score.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolode.llm.common import fresh, kept, parts_of, text_of, tidy

#: Bounds of training: labelled documents read, forms kept, chains trained on.
SAMPLE_DOCUMENTS = 8_000
FORMS = 20_000
CHAINS = 8_000
#: Shuffled copies of the labels that set the bar for a form, least toxic documents for it, and rounds of training.
SHUFFLES = 4
SUPPORT = 3
ROUNDS = 80
CHAIN = 256
BACKGROUND = 0.1
CACHE_WORDS = 100_000
PREFIXES = (3, 4, 5, 6)
SUFFIXES = (3, 4)
LONG_WORD = 40
PIECES = range(4, 13)

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")


@lru_cache(maxsize=CACHE_WORDS)
def _short_forms(token: str) -> tuple[str, ...]:
    return tuple(forms(token))


def _forms(token: str) -> tuple[str, ...] | list[str]:
    return _short_forms(token) if len(token) <= LONG_WORD else forms(token)


def forms(token: str) -> list[str]:
    """The word forms of a token: itself, its beginnings and its ends, and those of what it is joined from."""
    word = _EDGES.sub("", token.lower())
    if not word:
        return []
    inner = [w for w in _INNER.split(word) if w]
    words = [word] if len(inner) == 1 else [word, *inner]
    found = [f for w in words for f in (f"={w}", *(f"<{w[:k]}" for k in PREFIXES if len(w) >= k), *(f">{w[-k:]}" for k in SUFFIXES if len(w) >= k))]
    found += [f"={w[i : i + k]}" for w in inner if len(w) > LONG_WORD for k in PIECES for i in range(len(w) - k + 1)]
    return list(dict.fromkeys(found)) if len(found) > len(PREFIXES) + len(SUFFIXES) + 1 else found


def chains(text: str) -> list[list[str]]:
    found = []
    for line in text.split("\n"):
        words = line.split()
        found += [words[i : i + CHAIN] for i in range(0, len(words), CHAIN)]
    return found


@dataclass
class Field:
    """Weights of the field, for the toxic state less those for the clean one, and the curve of the score."""

    weights: dict[str, float]
    bias: float
    change: np.ndarray  # [state before, state]
    curve: tuple[float, float, float] = (0.0, 0.0, -20.0)

    def emission(self, token: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in _forms(token))


def marginals(emissions: np.ndarray, lengths: np.ndarray, change: np.ndarray, counts: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Chance of the toxic state at each token of padded chains (rows), and if asked of each change of state, summed.

    Messages are log odds, so nothing over- or underflows.
    """
    n, size = emissions.shape
    here = np.arange(size)[None, :] < lengths[:, None]
    forward, backward = np.zeros((n, size)), np.zeros((n, size))
    forward[:, 0] = emissions[:, 0]
    for t in range(1, size):
        # of the state before, given everything up to it
        x = forward[:, t - 1]
        forward[:, t] = emissions[:, t] + np.logaddexp(change[0, 1], x + change[1, 1]) - np.logaddexp(change[0, 0], x + change[1, 0])
    for t in range(size - 2, -1, -1):
        x = emissions[:, t + 1] + backward[:, t + 1]
        backward[:, t] = np.where(lengths > t + 1, np.logaddexp(change[1, 0], x + change[1, 1]) - np.logaddexp(change[0, 0], x + change[0, 1]), 0.0)
    chance = np.where(here, 1 / (1 + np.exp(-np.clip(forward + backward, -700, 700))), 0.0)
    if not counts:
        return chance, None
    # of pairs: before x now, in log odds against (clean, clean)
    x, y = forward[:, :-1], (emissions + backward)[:, 1:]
    logs = np.stack([np.broadcast_to(change[0, 0], x.shape), change[0, 1] + y, change[1, 0] + x, change[1, 1] + x + y])
    pairs = np.exp(logs - logs.max(axis=0))
    pairs = np.where(here[None, :, 1:], pairs / pairs.sum(axis=0), 0.0).sum(axis=(1, 2)) if size > 1 else np.zeros(4)
    return chance, pairs.reshape(2, 2)


def train(given: list[tuple[int, list[tuple[int, list[str], bool]]]], rounds: int = ROUNDS) -> Field:
    """The field for chains given as (length, [(place, forms, toxic)]); other tokens are clean and have no forms.

    Adam on the penalised likelihood; chains are grouped by length.
    """
    names = sorted({f for _, tokens in given for _, fs, _ in tokens for f in fs})
    number = {f: i for i, f in enumerate(names)}
    groups: dict[int, list] = {}
    for chain in given:
        groups.setdefault(int(np.ceil(np.log2(chain[0] + 1))), []).append(chain)
    parts = []
    seen = np.zeros(len(names) + 5)  # what the labels have: forms, bias, changes of state
    for group in groups.values():
        lengths = np.array([n for n, _ in group])
        width = int(lengths.max())
        spots = [(r * width + place, number[f]) for r, (_, tokens) in enumerate(group) for place, fs, _ in tokens for f in fs]
        at, which = (np.array(x, np.int64) for x in zip(*spots)) if spots else (np.zeros(0, np.int64),) * 2
        label = np.zeros((len(group), width))
        for r, (_, tokens) in enumerate(group):
            for place, _, toxic in tokens:
                label[r, place] = toxic
        here = np.arange(width)[None, :] < lengths[:, None]
        seen[: len(names)] += np.bincount(which, label.ravel()[at], len(names))
        seen[len(names)] += label.sum()
        pair = (label[:, :-1] * 2 + label[:, 1:])[here[:, 1:]].astype(int)
        seen[len(names) + 1 :] += np.bincount(pair, minlength=4)
        parts.append((lengths, width, at, which))
    weights = np.zeros(len(names) + 5)
    weights[len(names)] = -4.0
    mean, spread = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        change = weights[len(names) + 1 :].reshape(2, 2)
        expected = np.zeros_like(weights)
        for lengths, width, at, which in parts:
            scores = np.bincount(at, weights[which], len(lengths) * width).reshape(len(lengths), width) + weights[len(names)]
            chance, pairs = marginals(scores, lengths, change, True)
            expected[: len(names)] += np.bincount(which, chance.ravel()[at], len(names))
            expected[len(names)] += chance.sum()
            expected[len(names) + 1 :] += pairs.ravel()
        slope = seen - expected - 0.05 * weights
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        weights = weights + 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-6)
    kept_weights = {f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-3}
    return Field(kept_weights, float(weights[len(names)]), weights[len(names) + 1 :].reshape(2, 2))


class Tagger:
    """Marginals of whole texts under a field.

    A field has few forms. Words are first searched for the letters of any of them, all at once, and only the forms of
    those that have some are looked at. Most chains have no form at all; their marginals depend on their length alone
    and are computed once.
    """

    def __init__(self, field: Field):
        self.field, self.bare, self.letters = field, {}, None
        if field.weights:
            self.letters = ahocorasick.Automaton()
            for form in field.weights:
                self.letters.add_word(form[1:], 0)
            self.letters.make_automaton()

    def _bare(self, length: int) -> np.ndarray:
        if length not in self.bare:
            self.bare[length] = marginals(np.full((1, length), self.field.bias), np.array([length]), self.field.change)[0][0]
        return self.bare[length]

    def _emissions(self, words: list[str]) -> np.ndarray:
        kinds = list(set(words))
        text = "\n".join(kinds).lower()  # words have no line breaks, and lower case makes none
        hits = np.fromiter((end for end, _ in self.letters.iter(text)), np.int64) if self.letters else np.zeros(0, np.int64)
        ends = np.cumsum([len(w) + 1 for w in text.split("\n")])
        bias, emission = self.field.bias, self.field.emission
        known = {kinds[i]: emission(kinds[i]) for i in np.unique(np.searchsorted(ends, hits, "right"))}
        return np.array([known.get(w, bias) for w in words])

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the marginals of its tokens, in order."""
        parts = [chains(t) for t in texts]
        flat = [c for part in parts for c in part]
        if not flat:
            return [np.zeros(0) for _ in texts]
        lengths = np.array([len(c) for c in flat])
        edges = np.concatenate([[0], np.cumsum(lengths)])
        scores = self._emissions([w for c in flat for w in c])
        out = np.zeros(len(scores))
        formed = np.concatenate([[0], np.cumsum(scores != self.field.bias)])
        bare = formed[edges[1:]] == formed[edges[:-1]]
        for k in np.flatnonzero(bare):
            out[edges[k] : edges[k + 1]] = self._bare(int(lengths[k]))
        order, at = np.argsort(lengths, kind="stable"), 0
        order = order[~bare[order]]
        while at < len(order):  # chains of about one length at a time
            widest = max(int(lengths[order[at]] * 1.25), 8)
            end = min(int(np.searchsorted(lengths[order], widest, "right")), at + max(1, 400_000 // widest))
            rows, n = order[at:end], lengths[order[at:end]]
            spots = edges[rows][:, None] + np.arange(n[-1])[None, :]
            here = np.arange(n[-1])[None, :] < n[:, None]
            chance, _ = marginals(np.where(here, scores[np.minimum(spots, len(scores) - 1)], 0.0), n, self.field.change)
            out[spots[here]] = chance[here]
            at = end
        ends = np.cumsum([sum(map(len, part)) for part in parts])
        return np.split(out, ends[:-1])


@lru_cache(maxsize=1)
def _tagger(written: bytes) -> Tagger:
    """The tagger of this process for a field, so that tasks share what is remembered."""
    return Tagger(pickle.loads(written))


def summary(chance: np.ndarray) -> tuple[float, float]:
    """Log odds of the largest marginal, and log of one more than the sum of those that are no mere background.

    The background of a long text adds up to any number, so it is left out of the sum.
    """
    if not len(chance):
        return -20.0, 0.0
    top = float(np.clip(chance.max(), 2e-9, 1 - 2e-9))
    return float(np.log(top / (1 - top))), float(np.log1p(chance[chance >= BACKGROUND].sum()))


def score(field: Field, chance: np.ndarray) -> float:
    a, b, c = field.curve
    x, y = summary(chance)
    return float(1 / (1 + np.exp(-np.clip(a * x + b * y + c, -500, 500))))


def spans(text: str, chance: np.ndarray, least: float = 0.5) -> list[tuple[int, int]]:
    """Code-point offsets of runs of tokens whose marginal is at least ``least``."""
    if not len(chance) or chance.max() < least:
        return []
    found, joins, at = [], False, 0
    for line in re.finditer(r"[^\n]+", text):
        joins = False
        for token in re.finditer(r"\S+", line[0]):
            if chance[at] >= least:
                begin, end = line.start() + token.start(), line.start() + token.end()
                if joins:
                    found[-1] = (found[-1][0], end)
                else:
                    found.append((begin, end))
            joins = bool(chance[at] >= least)
            at += 1
    return found


def fit_curve(points: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, lightly penalised; constant if only one label occurs."""
    x = np.column_stack([points, np.ones(len(points))])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - 0.1 * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return tuple(float(v) for v in w)


def _surprise(n1: Column, n0: Column, all1: float, all0: float) -> Column:
    """Log-likelihood ratio of a form's documents under two rates against one; 0 if it isn't commoner in toxic ones."""
    n, rate = n1 + n0, all1 / (all1 + all0)
    part = lambda a, e: F.when(a > 0, a * F.log(a / e)).otherwise(0.0)
    rest = part(all1 - n1, (all1 + all0 - n) * rate) + part(all0 - n0, (all1 + all0 - n) * (1 - rate))
    value = 2 * (part(n1, n * rate) + part(n0, n * (1 - rate)) + rest)
    return F.when(n1 > n * rate, value).otherwise(0.0)


def _forms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct forms of each document (row, text, y, shuffled labels...), with the labels, counted over the batch."""
    for batch in batches:
        labels = np.array([batch.column(i).to_pylist() for i in range(1, batch.num_columns)], np.int64).T
        sums: dict[str, np.ndarray] = {}
        ones = np.concatenate([labels, 1 - labels[:, :1]], axis=1)
        for text, row in zip(batch.column(0).to_pylist(), ones):
            for form in {f for w in set(text.split()) for f in _forms(w)}:
                if form in sums:
                    sums[form] += row
                else:
                    sums[form] = row.copy()
        counts = np.array(list(sums.values())).reshape(len(sums), -1)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), *(pa.array(c) for c in counts.T)], names=["form", *(f"n{i}" for i in range(counts.shape[1]))])


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Field:
    """A field from ``docs`` (doc_id, text) and ``labels`` (doc_id and the label, 0 or 1).

    Of labelled documents with equal texts and labels the one with the smallest id is read, and of what is left at most
    SAMPLE_DOCUMENTS, those with the smallest hash of doc_id. Of the forms above the bar the FORMS most telling are kept.
    Labels other than 0 and 1 are ignored. If one of the labels is missing, or no form stands out, every score is near 0.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).cast("int").alias("y"))
    given = docs.select(F.col("doc_id").cast("long").alias("id"), text_of("text").alias("text"), F.xxhash64(text_of("text")).alias("hash"))
    # copies would make all their words look like marks
    firsts = given.select("id", "hash").join(known, "id").groupBy("hash", "y").agg(F.min("id").alias("id"))
    picked = firsts.orderBy(F.xxhash64("id"), "id", "hash").limit(SAMPLE_DOCUMENTS)
    rows = given.join(F.broadcast(picked), ["id", "hash"]).groupBy("id", "hash", "y").agg(F.first("text").alias("text"))
    sample = kept(rows.select("id", "text", "y").repartition(24, "id"), "labelled")
    totals = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    none = Field({}, -20.0, np.zeros((2, 2)))
    if len(totals) < 2:
        return none
    rate = totals[1] / (totals[0] + totals[1])
    shuffled = [(F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(1 << 30)) < int(rate * (1 << 30))).cast("int") for k in range(SHUFFLES)]
    sums = sample.select("text", "y", *shuffled).mapInArrow(tidy(_forms_of), ", ".join(["form string", *(f"n{i} long" for i in range(SHUFFLES + 2))]))
    sums = sums.groupBy("form").agg(*(F.sum(f"n{i}").alias(f"n{i}") for i in range(SHUFFLES + 2)))
    clean = F.col(f"n{SHUFFLES + 1}")
    both = F.col("n0") + clean
    real = _surprise(F.col("n0"), clean, totals[1], totals[0])
    chance = F.greatest(*(_surprise(F.col(f"n{k + 1}"), both - F.col(f"n{k + 1}"), totals[1], totals[0]) for k in range(SHUFFLES)))
    scored = kept(sums.select("form", "n0", real.alias("real"), chance.alias("chance")), "forms")
    bar = scored.agg(F.max("chance")).first()[0] or 0.0
    marks = [r["form"] for r in scored.where((F.col("real") > bar) & (F.col("n0") >= SUPPORT)).orderBy(F.desc("real"), "form").limit(FORMS).collect()]
    if not marks:
        return none
    strong = frozenset(marks)

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, y in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for k, chain in enumerate(chains(text)):
                    tokens = [(place, fs) for place, w in enumerate(chain) if (fs := [f for f in _forms(w) if f in strong])]
                    if tokens or (doc + k) % 16 == 0:
                        rows.append((len(chain), [p for p, _ in tokens], [fs for _, fs in tokens], y))
            length, places, has, y = zip(*rows) if rows else ((), (), (), ())
            columns = [pa.array(length, pa.int64()), pa.array(places, pa.list_(pa.int32())), pa.array(has, pa.list_(pa.list_(pa.string()))), pa.array(y, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["length", "places", "forms", "y"])

    rows = sample.select("id", "text", "y").mapInArrow(tidy(chained), "length long, places array<int>, forms array<array<string>>, y int")
    rows = rows.orderBy(F.xxhash64("length", "places", "forms"), "length").limit(CHAINS).collect()
    field = train([(r["length"], [(p, list(fs), r["y"] == 1) for p, fs in zip(r["places"], r["forms"])]) for r in rows])

    points = [(r["x"], r["z"], r["y"]) for r in _summaries(sample, field).collect()]
    data = np.array(points, np.float64)
    field.curve = fit_curve(data[:, :2], data[:, 2])
    return field


def _summaries(sample: DataFrame, field: Field) -> DataFrame:
    written = pickle.dumps(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(written)
        for batch in parts_of(batches, 64):
            found = [summary(c) for c in tagger.tag(batch.column(0).to_pylist())]
            x, z = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), pa.array(z, pa.float64()), batch.column(1)], names=["x", "z", "y"])

    return sample.select("text", "y").mapInArrow(tidy(run), "x double, z double, y int")


def tag_documents(docs: DataFrame, field: Field, names: tuple[str, str, str] = ("toxicity", "toxic_words", "toxic_spans")) -> DataFrame:
    """``docs`` with columns toxicity (0 to 1), toxic_words (expected number) and toxic_spans (code-point offsets).

    Null and empty texts are scored like texts without tokens. All rows and columns stay; input columns of the three
    ``names`` are replaced. An empty table gives no rows.
    """
    own = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    # mapInArrow reads columns by name, dots as paths; so they are numbered meanwhile
    rows = docs.select(text_of("text"), *(F.col(f"`{c}`") for c in own)).toDF(*(f"c{i}" for i in range(len(own) + 1)))
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    spark_span = T.ArrayType(T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()))
    schema = T.StructType([*rows.schema.fields[1:]]).add("t1", T.DoubleType()).add("t2", T.DoubleType()).add("t3", spark_span)
    written, labels = pickle.dumps(field), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(written)
        for part in parts_of(batches, 128):
            texts = part.column(0).to_pylist()
            chances = tagger.tag(texts)
            columns = [
                *part.columns[1:],
                pa.array([score(field, c) for c in chances], pa.float64()),
                pa.array([float(c.sum()) for c in chances], pa.float64()),
                pa.array([[{"start": a, "end": b} for a, b in spans(t, c)] for t, c in zip(texts, chances)], span),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=labels)

    return rows.mapInArrow(tidy(run), schema).toDF(*own, *names)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 0 when divided by 5; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drop_toxic(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """``docs`` without those whose toxicity is at least ``least``; labels of held-out rows are not used."""
    field = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    names = tuple(fresh(docs, n) for n in ("document_toxicity", "toxic_words", "toxic_spans"))
    scored = tag_documents(docs, field, names)
    return scored.where(F.col(names[0]) < least).drop(*names)
