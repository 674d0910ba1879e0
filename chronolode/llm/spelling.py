"""Spelling variants of words by permuterm rotations.

A word w is marked with a terminator, w$, and all rotations of it are sorted. Words that differ by one replaced code
point have rotations that are equal but for their last code point, the replaced one; a word with one code point more
has a rotation that is a rotation of the shorter word and that code point. So near words are those whose rotations
share a prefix that skips the edited code point. The rotations are sorted by that prefix over ranges of it, and one scan
sees each group of equal prefixes together: at most one word for every letter and one without, whatever the input.
A group is read once: every member learns how many others are near and the most frequent of them, so nothing is paired.

Of a run of equal letters only the first counts as the one too many ("hello" without its first l), so each pair of near
words meets in exactly one group.

Defined cases: null texts hold no words; a null id reads as an empty one; repeated rows count again; no words, no rows.
Texts are read in parts of a megabyte, cut at white space. Further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolode.llm.common import Batches, byte_chunks, kept, parts_of, text_of, tidy

END = "$"
LEAST_CHARS = 5
LEAST_COUNT = 3
#: A form occurs at least this many times as often as its variant.
RATIO = 2
#: One in this many kinds of (document, word) is misspelt on purpose, as the query's contract has it.
SLIPS = 97
#: Words counted in a task before their counts are passed on.
HELD = 200_000

_RUN = re.compile("[a-zÀ-ÿ]+")


def slipped(doc: str, word: str, slips: int = SLIPS) -> str:
    """``word`` as ``doc`` spells it: without one code point where the checksum of both is divisible by ``slips``."""
    h = zlib.crc32(f"{doc}:{word}".encode())
    at = h % len(word)
    return word if h % slips else word[:at] + word[at + 1 :]


def _counted(slips: int | None):
    def run(batches: Batches) -> Batches:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in parts_of(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in byte_chunks(text.as_buffer().to_pybytes()):
                    # lower() of bytes knows A-Z alone
                    for word, n in Counter(_RUN.findall(part.lower().decode())).items():
                        spelt = word if slips is None else slipped(doc, word, slips)
                        if len(spelt) >= LEAST_CHARS:
                            counts[spelt] += n
                if len(counts) >= HELD:
                    yield flush()
        yield flush()

    return tidy(run)


def vocabulary(docs: DataFrame, slips: int | None = None) -> DataFrame:
    """Words (word, n) of all texts of ``docs`` (doc_id, text) with enough code points and occurrences."""
    read = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of("text"))
    return read.mapInArrow(_counted(slips), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """Rotations of all ``words`` (word, n) as (prefix, skipped, single, n), 2 * length + 1 for a word.

    ``skipped`` is the code point after the prefix, empty where the prefix is the whole rotation; ``single`` tells
    whether the word without it is a shorter word's rotation that counts.
    """
    spots = F.expr(
        f"""transform(sequence(1, char_length(word)), i -> struct(
              concat(substring(word, i + 1), '{END}', substring(word, 1, i - 1)) AS prefix, substring(word, i, 1) AS skipped,
              i = 1 OR substring(word, i, 1) <> substring(word, i - 1, 1) AS single))"""
    )
    gaps = F.expr(
        f"""transform(sequence(1, char_length(word) + 1), i -> struct(
              concat(substring(word, i), '{END}', substring(word, 1, i - 1)) AS prefix, '' AS skipped, true AS single))"""
    )
    return words.select(F.explode(F.concat(spots, gaps)).alias("r"), "n").select("r.*", "n")


def _word(prefix: str, skipped: str) -> str:
    after, before = prefix.split(END)
    return before + skipped + after


def _near(members: list[tuple[str, str, bool, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words here, count and text of the most frequent) for members with any; all share their prefix."""
    spelt = [(-n, _word(prefix, skipped), skipped, single) for prefix, skipped, single, n in members]
    long = sorted(m for m in spelt if m[2])
    short = [m for m in spelt if not m[2]]
    for n, word, _, single in long:
        best = [m for m in long[:2] if m[1] != word][:1] + (short if single else [])
        if best:
            top = min(best)
            yield word, len(long) - 1 + (len(short) if single else 0), -top[0], top[1]
    for n, word, _, _ in short:
        more = [m for m in long if m[3]]
        if more:
            yield word, len(more), -more[0][0], more[0][1]


def _scanned(batches: Batches) -> Batches:
    """Near words of sorted rotations; a group that a batch cuts waits for the rest of it."""
    names = ["word", "n_near", "best_n", "best"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]

    def groups(rows: pa.RecordBatch) -> pa.RecordBatch:
        prefix = rows.column("prefix")
        same = pc.equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False) if len(rows) > 1 else []
        found, at = [], 0
        while at < len(same):
            if not same[at]:
                at += 1
                continue
            end = at
            while end < len(same) and same[end]:
                end += 1
            part = rows.slice(at, end + 1 - at)
            found.extend(_near(list(zip(*(c.to_pylist() for c in part.columns)))))
            at = end + 1
        columns = list(zip(*found)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    held = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        last = rows.column("prefix")[len(rows) - 1]
        open_from = pc.index(rows.column("prefix"), last).as_py()
        held = rows.slice(open_from)
        if open_from:
            yield groups(rows.slice(0, open_from))
    if held is not None:
        yield groups(held)


def near_words(words: DataFrame) -> DataFrame:
    """Per word of ``words`` (word, n) and group with a near word: (word, n_near, best_n, best)."""
    ranged = rotations(words).repartitionByRange("prefix").sortWithinPartitions("prefix", "skipped")
    return ranged.mapInArrow(tidy(_scanned), "word string, n_near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the end of the chain of forms.

    Every step at least doubles the count, so no chain has more than 63 steps or comes back. Each round doubles the
    steps known, and is written to the shared folder.
    """
    links = kept(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        next_ = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        moved = links.join(next_, "root", "left")
        links = kept(moved.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "forms")
        if links.where("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def spelling_variants(words: DataFrame) -> DataFrame:
    """``words`` (word, n) with form, root, n_near and form_n, one row per word.

    The form of a word is its most frequent near word (ties: the first in code-point order) if that occurs at least
    twice as often, else null; its root is the last of the chain of forms.
    """
    words = kept(words.select("word", "n"), "words")
    none = F.lit(None)
    rows = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.cast("long").alias("best_n"), none.cast("string").alias("best"))
    rows = rows.unionByName(near_words(words).select("word", none.cast("long").alias("n"), "n_near", "best_n", "best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form"))))
    known = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best"))
    has = -F.col("best.less") >= RATIO * F.col("n")
    known = kept(
        known.select("word", "n", "n_near", F.when(has, F.col("best.form")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")), "near-words"
    )
    ends = roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
