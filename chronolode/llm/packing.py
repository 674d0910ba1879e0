"""Best-two-fit packing of token pieces into sequences of a fixed length.

Packing depends on lengths alone, and there are at most as many lengths as a sequence has tokens. So the plan is made
from the histogram of lengths, whose size is bounded, and says how many sequences have which lengths in which order.
Pieces then take places by their rank among the pieces of equal length: nothing but the histogram reaches the driver.

The plan fills a sequence greedily with the longest pieces that fit. Then it takes its smallest piece out and looks for
two unpacked pieces that fill the larger gap more tightly. A sequence found this way is repeated as often as the
histogram allows.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronolode.llm.common import fresh, kept, parts_of, text_of, tidy

LENGTH = 1024
END_ID = 2
CACHE_WORDS = 400_000
LONG_WORD = 100
#: Marks a word may end in, and kinds of such ends that are remembered.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MOST_TAILS = 10_000
#: How the vocabulary file writes a space and a line break.
SPACE = "Ġ"
BREAK = "Ċ"
#: Groups of ranks of one length: at least so many, and more once they would exceed so many rows.
RANK_GROUPS = 64
RANK_ROWS = 16_384


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of texts by a byte-level BPE file, as little-endian unsigned 32-bit ids.

    The tokenizer never merges across a space or line break between two other characters, nor between a letter or digit
    and a mark, so a text is cut at the former and ids of its words are remembered: those of the last ``words`` or fewer,
    in two halves of which the older is given up. New words are encoded many at a time, without the marks they end in; a
    token that begins with a space or break begins a word. A text with any other spacing goes to the tokenizer whole.
    """

    def __init__(self, path: str, words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.words = Tokenizer.from_file(path), words
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith(SPACE) or token == BREAK]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> None:
        """Remember ids of words, each with the space or break in front of it."""
        written = [w if w[0] == "\n" else f" {w}" for w in words]
        parts = [(words[i : i + 64], written[i : i + 64]) for i in range(0, len(words), 64)]
        for (part, texts), found in zip(parts, self.tokenizer.encode_batch_fast(["".join(t) for _, t in parts], add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) == len(part) and starts[0] == 0:
                data, edges = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
                self.known.update((w, data[i:j]) for w, i, j in zip(part, edges, edges[1:]))
            else:
                self.known.update(zip(part, self._whole(texts)))

    def _learn(self, words: list[str]) -> None:
        plain, marked = [], []
        for word in words:
            base = word.rstrip(MARKS)
            if len(base) < len(word) and base and base[-1].isalnum() and not any(s in word for s in self.special):
                marked.append((word, base, word[len(base) :]))
            else:
                plain.append(word)
        bases = {b for _, b, _ in marked}.difference(self.known, plain)
        self.known.update((b, self.older[b]) for b in bases & self.older.keys())
        bases.difference_update(self.known)
        # breaks inside a word would look like beginnings
        broken = [w for w in plain if "\n" in w[1:]]
        self._encode_words([*(w for w in plain if "\n" not in w[1:]), *(b for b in bases if "\n" not in b[1:])])
        broken += [b for b in bases if "\n" in b[1:]]
        self.known.update(zip(broken, self._whole([w if w[0] == "\n" else f" {w}" for w in broken])))
        tails = list({t for _, _, t in marked}.difference(self.tails))
        self.tails.update(zip(tails, self._whole(tails)))
        self.known.update((w, self.known[b] + self.tails[t]) for w, b, t in marked)
        if len(self.tails) > MOST_TAILS:
            self.tails = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        breaks = ["\n" in t and not (" \n" in t or "\n " in t or "\n\n" in t) for t in texts]
        cut = [(t.replace("\n", " \n") if b else t).split(" ") for t, b in zip(texts, breaks)]
        firsts = [words.pop(0) for words in cut]
        new = set(chain.from_iterable(cut)).difference(self.known)
        again = self.older.keys() & new
        self.known.update((w, self.older[w]) for w in again)
        # an empty word, or white space beside the cut, is another spacing
        new = [w for w in new - again if w and not w[-1].isspace() and (not w[0].isspace() or w[0] == "\n" and not w[1].isspace())]
        self._learn(new)
        plain = [bool(w) and not w[-1].isspace() and (b or " \n" not in t) for t, w, b in zip(texts, firsts, breaks)]
        heads = self._whole([w if ok else "" for w, ok in zip(firsts, plain)])
        ids_of, found = self.known.__getitem__, []
        for text, words, ok, head in zip(texts, cut, plain, heads):
            try:
                found.append(head + b"".join(map(ids_of, words)) if ok else self._whole([text])[0])
            except KeyError:
                found.append(self._whole([text])[0])
        for word in new:
            if len(word) > LONG_WORD:
                del self.known[word]
        if 2 * len(self.known) > self.words:
            self.known, self.older = {}, self.known
        return found


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """The encoder of this process: its tasks read the file once and share what is remembered of words."""
    return Encoder(path)


def cuts(n: int, length: int) -> list[int]:
    """Where the pieces of n ids begin, and n: only the first piece may be shorter than ``length`` if there are more."""
    return [0, *range(n % length or length, n + 1, length)] if n > length else [0, n]


def token_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text): doc_id, piece, start, length, ids.

    A document's ids are those of its text (null: empty) and ``end_id``. Documents of more than ``length`` ids are cut.
    ids holds little-endian unsigned 32-bit numbers. Repeated rows stay repeated; an empty table gives no rows.
    """
    path = path or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)

        def out(rows):
            doc, piece, start, size, ids = zip(*rows)
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(ids, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])

        for part in parts_of(batches):
            rows = []
            for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1).to_pylist())):
                ids += end
                edges = cuts(len(ids) // 4, length)
                rows += [(doc, i, a, b - a, ids[4 * a : 4 * b]) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
            yield out(rows)

    schema = "doc_id long, piece int, start long, length long, ids binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(tidy(run), schema)


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[list[int], int]]:
    """Sequences as (lengths in order, how many), by greedy filling and best two-fit."""
    left = np.zeros(length + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    made = []
    while left.any():
        sizes = np.flatnonzero(left)
        first = int(sizes[-1])
        took, gap = Counter({first: 1}), length - first

        def fits(gap: int) -> int:
            """The longest unpacked piece of at most gap tokens, or 0."""
            at = int(np.searchsorted(sizes, gap, "right")) - 1
            while at >= 0 and left[sizes[at]] <= took[int(sizes[at])]:
                at -= 1
            return int(sizes[at]) if at >= 0 else 0

        while gap and (more := fits(gap)):
            took[more] += 1
            gap -= more
        smallest = min(took)
        if gap and sum(took.values()) > 1:
            took[smallest] -= 1
            room = gap + smallest
            free = sizes[left[sizes] > np.array([took[int(s)] for s in sizes])]
            free = free[free < room]
            best = (smallest, None)
            mates = np.searchsorted(free, room - free, "right") - 1
            ok = mates >= 0
            if ok.any():
                a, b = free[ok], free[mates[ok]]
                twice = (a == b) & (left[a] - np.array([took[int(s)] for s in a], np.int64) < 2)
                # one piece can't be both: its mate is then the next shorter length
                b = np.where(twice, np.where(mates[ok] > 0, free[np.maximum(mates[ok] - 1, 0)], 0), b)
                total = np.where(b > 0, a + b, 0)
                k = int(np.argmax(total))
                if total[k] > best[0]:
                    best = (int(total[k]), (int(a[k]), int(b[k])))
            if best[1]:
                took[best[1][0]] += 1
                took[best[1][1]] += 1
            else:
                took[smallest] += 1
        took = +took
        times = int(min(left[s] // n for s, n in took.items()))
        for s, n in took.items():
            left[s] -= times * n
        made.append((sorted(took.elements(), reverse=True), times))
    return made


def places(made: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """The plan by pieces: those of a length with ranks from a to b go to sequence + rank - a, at an offset."""
    used, sequence, rows = Counter(), 0, []
    for sizes, times in made:
        offset = 0
        for size in sizes:
            rows.append((size, used[size], used[size] + times - 1, sequence, offset))
            used[size] += times
            offset += size
        sequence += times
    return rows


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any others) with sequence_id and offset, gapless in each sequence.

    Ranks are counted within (length, hash of the piece) and added up, so no group holds more than a share of the rows.
    Input columns sequence_id and offset are replaced. An empty table gives no rows.
    """
    salt, rank, base, rows_of = (fresh(pieces, n) for n in ("salt", "rank", "base", "rows_of_length"))
    pieces = kept(pieces.drop("sequence_id", "offset"), "pieces")
    spread = RANK_GROUPS + pieces.count() // RANK_ROWS
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(spread)).cast("int"))
    sums = salted.groupBy("length", salt).agg(F.count("*").alias(rows_of))
    # at most length rows
    histogram = {int(r["length"]): int(r[1]) for r in sums.groupBy("length").agg(F.sum(rows_of)).collect()}
    if any(not 0 < s <= length for s in histogram):
        raise ValueError(f"pieces must have 1 to {length} tokens")
    bases = sums.withColumn(base, F.sum(rows_of).over(Window.partitionBy("length").orderBy(salt)) - F.col(rows_of)).drop(rows_of)
    ranked = salted.withColumn(rank, F.row_number().over(Window.partitionBy("length", salt).orderBy("doc_id", "piece")) - 1)
    ranked = ranked.join(bases, ["length", salt]).withColumn(rank, F.col(rank) + F.col(base)).drop(salt, base)
    low, high, sequence, offset = (fresh(pieces, n) for n in ("rank_from", "rank_to", "first_sequence", "offset"))
    table = pieces.sparkSession.createDataFrame(places(plan(histogram, length)), f"length long, {low} long, {high} long, {sequence} long, {offset} long")
    placed = ranked.join(F.broadcast(table), "length").where(F.col(rank).between(F.col(low), F.col(high)))
    return placed.withColumn("sequence_id", F.col(sequence) + F.col(rank) - F.col(low)).drop(rank, low, high, sequence)


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces of ``docs`` with their ids, sequence_id and offset."""
    return pack(token_pieces(docs, path, length), length)
