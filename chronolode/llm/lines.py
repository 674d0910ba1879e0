"""Near-duplicate lines by a deletion-neighbourhood join.

Two lines are within one edit (a code point inserted, deleted or replaced) if and only if they have a variant in common
that leaves out one code point at most. Lines emit their variants as hashed keys, an equality shuffle brings equal
variants together, and links are verified by edit distance.

A line is removed if an earlier line, by (doc_id, line number), is within the bound. Two facts keep the work linear:

* Lines that become equal by leaving out the same position differ in that position alone. The earliest of such a group
  is within the bound of every other member, so each member needs one link, to it.
* A line that equals a variant of longer lines is one distinct line, so each of those needs one link, to it or from it.

Variants are made only for lines that can have a partner: with one edit, two lines agree in their first or last half.
Exact copies are classed by a 128-bit hash before that, so a line is compared once however often it occurs. Of lines
shorter than ``MIN_CHARS``, where one edit makes another word, only exact copies count; blank ones are structure and stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolode.llm.common import fresh, kept, parts_of, text_of, tidy

MIN_CHARS = 10
NO_ID = (1 << 63) - 1
#: White space in a line, as the engine's patterns have it.
BLANKS = " \t\x0b\f\r"

#: Multipliers of the two rolling hashes, and of the code points' mix.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
MIXES = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
VARIANT_ROWS = 200_000
#: What tells lines apart: where they are, and hashes of the line and its whole text for rows that share a doc_id.
AT = ["doc", "line_no", "h1", "row"]


def _key() -> list[Column]:
    """doc and row, which tell rows apart that have different ids or texts."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text_of("text")).alias("row")]


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line of ``docs`` (doc_id, text): doc, row (a hash of the text), line_no, a 128-bit hash (h1, h2) and keys of its halves.

    Lines end at line feeds. Shorter lines than ``min_chars`` code points have no halves, and blank ones of them are left out.
    """
    rows = docs.select(*_key(), F.posexplode(F.split(text_of("text"), "\n", -1)).alias("line_no", "line"))
    rows = rows.withColumn("chars", F.char_length("line")).where((F.col("chars") >= min_chars) | F.col("line").rlike(r"\S"))
    ends = "transform(array_distinct(array(chars div 2, (chars - 1) div 2)), p -> named_struct('p', CAST(p AS INT)))"
    keys = f"flatten(transform({ends}, e -> array(xxhash64(1, e.p, substring(line, 1, e.p)), xxhash64(2, e.p, substring(line, CAST(chars AS INT) - e.p + 1, e.p)))))"
    return rows.select("doc", "row", "line_no", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(7), "line").alias("h2"), F.when(F.col("chars") >= min_chars, F.expr(keys)).otherwise(F.array().cast("array<bigint>")).alias("halves"))


def _mixed(points: np.ndarray, mix: int) -> np.ndarray:
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(mix)
    return x ^ (x >> np.uint64(29))


def variant_keys(line: str) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the line without its i-th code point for every i, and of the whole line at the end."""
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4")
    found = []
    for base, mix in zip(BASES, MIXES):
        powers = np.full(len(points) + 1, base, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(points, mix) * powers[:-1], dtype=np.uint64)])
        inverse = np.uint64(pow(base, -1, 1 << 64))
        found.append(np.append(before[:-1] + (before[-1] - before[1:]) * inverse, before[-1]).view(np.int64))
    return found[0], found[1]


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, place, doc, line_no, h1, row) of lines (doc, line_no, h1, row, line); place -1 is the whole line."""
    names = ["k1", "k2", "place", *AT]

    def out(held):
        k1, k2, place, doc, number, h1, row = (np.concatenate(x) for x in zip(*held))
        return pa.RecordBatch.from_arrays([pa.array(k1), pa.array(k2), pa.array(place, pa.int32()), pa.array(doc), pa.array(number, pa.int32()), pa.array(h1), pa.array(row)], names=names)

    for batch in parts_of(batches, 1024):
        held, size = [], 0
        for doc, number, h1, row, line in zip(*(batch.column(i).to_pylist() for i in range(5))):
            k1, k2 = variant_keys(line)
            place = np.append(np.arange(len(k1) - 1), -1)
            held.append((k1, k2, place, np.full(len(k1), doc, np.int64), np.full(len(k1), number, np.int32), np.full(len(k1), h1, np.int64), np.full(len(k1), row, np.int64)))
            size += len(k1)
            if size > VARIANT_ROWS:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)


def _links(variants: DataFrame) -> DataFrame:
    """(at, to): from later to earlier lines that share a variant as described above."""
    at = F.struct(*AT)
    same = Window.partitionBy("k1", "k2")
    rows = variants.withColumn("n", F.count("*").over(same)).where("n > 1")
    rows = rows.withColumn("whole", F.min(F.when(F.col("place") == -1, at)).over(same))
    rows = rows.withColumn("first", F.min(at).over(Window.partitionBy("k1", "k2", "place")))
    rows = rows.withColumn("own", at)
    cases = F.array(
        F.when((F.col("place") >= 0) & (F.col("first") < F.col("own")), F.struct(F.col("own").alias("later"), F.col("first").alias("earlier"))),
        F.when((F.col("place") >= 0) & (F.col("whole") != F.col("own")), F.struct(F.greatest("whole", "own").alias("later"), F.least("whole", "own").alias("earlier"))),
    )
    links = rows.select(F.explode(F.array_compact(cases)).alias("x"))
    return links.select(F.col("x.later").alias("at"), F.col("x.earlier").alias("to")).distinct()


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Lines of ``docs`` (doc_id, text) that have an earlier line within one edit.

    Returns doc_id, line_no (from 0), seen_doc_id and seen_line_no (the earliest line within the bound, which may itself
    be removed), edits (0 or 1). Order is by doc_id, null last, then line number; null and empty texts have one empty
    line. Lines under ``min_chars`` code points have no edits: they are removed where an equal line came before, and blank
    ones of them never. Of lines at one
    place of rows that share a doc_id, or have none, the order is that of hashes of the line and its text; of rows equal in
    both, all but one have their lines listed, seen at their own place. Further columns are ignored; an empty table gives no
    rows.
    """
    lines, named = _named(docs, min_chars)
    at = F.struct(*AT)
    copies = docs.select(*_key()).groupBy("doc", "row").agg(F.count("*").alias("copies")).where("copies > 1")
    again = lines.join(copies, ["doc", "row"]).dropDuplicates(AT).join(named, ["h1", "h2"]).where(at == F.col("seen"))
    again = again.withColumn("copy", F.explode(F.expr("sequence(2L, copies)")))
    columns = ["doc", "line_no", "seen", "edits"]
    gone = lines.join(named, ["h1", "h2"]).where(at > F.col("seen")).select(*columns).union(again.select(*columns))
    ids = [F.expr(f"nullif({c}, {NO_ID}L)") for c in ("doc", "seen.doc")]
    return gone.select(ids[0].alias("doc_id"), "line_no", ids[1].alias("seen_doc_id"), F.col("seen.line_no").alias("seen_line_no"), "edits")


def _named(docs: DataFrame, min_chars: int) -> tuple[DataFrame, DataFrame]:
    """The lines of ``docs``, and of repeated ones (h1, h2) the earliest place within the bound (seen) and edits."""
    lines = kept(line_rows(docs, min_chars), "lines")
    at = F.struct(*AT)
    classes = kept(lines.groupBy("h1", "h2").agg(F.min(at).alias("at"), F.first("halves").alias("halves"), F.count("*").alias("n")), "line-classes")
    halves = classes.select("at", F.explode("halves").alias("half"))
    alike = halves.withColumn("n", F.count("*").over(Window.partitionBy("half"))).where("n > 1").select("at.*").distinct()

    source = docs.select(*_key(), text_of("text").alias("text"))
    wanted = alike.groupBy("doc", "row").agg(F.collect_set("line_no").alias("wanted"))
    texts = source.join(wanted, ["doc", "row"]).select("doc", "row", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"), "wanted")
    texts = texts.where("array_contains(wanted, line_no)").select("doc", "line_no", F.xxhash64("line").alias("h1"), "row", "line")
    texts = kept(texts.where(F.char_length("line") >= min_chars).dropDuplicates(AT), "line-texts")

    links = _links(texts.mapInArrow(tidy(_variants), "k1 long, k2 long, place int, doc long, line_no int, h1 long, row long"))
    one, other = texts.select(at.alias("at"), "line"), texts.select(at.alias("to"), F.col("line").alias("to_text"))
    near = links.join(one, "at").join(other, "to").where(F.levenshtein("line", "to_text", 1) == 1)
    named = near.groupBy("at").agg(F.min("to").alias("seen"))
    named = classes.join(named, "at", "left").where("n > 1 OR seen IS NOT NULL")
    return lines, named.select("h1", "h2", F.coalesce("seen", "at").alias("seen"), F.col("seen").isNotNull().cast("int").alias("edits"))


def _without(batches: Iterator[pa.RecordBatch], text: int, gone: int, count: int | None, min_chars: int) -> Iterator[pa.RecordBatch]:
    """The batches with the named lines taken out of the texts, and all lines of rows that are a further copy (the column
    after that of the names is above 1); rows whose every line went are left out."""
    for batch in parts_of(batches):
        texts, stays = batch.column(text).to_pylist(), []
        for i, (numbers, copy) in enumerate(zip(batch.column(gone).to_pylist(), batch.column(gone + 1).to_pylist())):
            if numbers or (copy > 1 and texts[i]):
                drop = set(numbers or ())
                left = [x for n, x in enumerate(texts[i].split("\n")) if n not in drop and not (copy > 1 and (len(x) >= min_chars or x.strip(BLANKS)))]
                texts[i] = "\n".join(left) if left else None
                if not left:
                    continue
            stays.append(i)
        columns = list(batch.columns)
        columns[text] = pa.array(texts, pa.string())
        if count is not None:
            columns[count] = pa.array([None if t is None else len(t) for t in texts], columns[count].type)
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema).take(pa.array(stays, pa.int64()))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the lines of ``removed_lines`` taken out of text, and n_chars counted anew where it exists.

    Documents of which no line is left are dropped; all others stay, also null and empty ones. All columns stay. Each row
    loses its own lines only, whether its doc_id is null, repeated or its own.
    """
    mark, doc, row, copy = (fresh(docs, name) for name in ("gone_lines", "gone_doc", "gone_row", "gone_copy"))
    lines, named = _named(docs, min_chars)
    gone = lines.join(named, ["h1", "h2"]).where(F.struct(*AT) > F.col("seen"))
    gone = gone.groupBy(F.col("doc").alias(doc), F.col("row").alias(row)).agg(F.collect_set("line_no").alias(mark))
    keyed = docs.select("*", *(c.alias(name) for c, name in zip(_key(), (doc, row))))
    rows = keyed.join(gone, [doc, row], "left")
    rows = rows.withColumn(copy, F.row_number().over(Window.partitionBy(doc, row).orderBy(row))).select(*docs.columns, mark, copy)
    text, last = docs.columns.index("text"), len(docs.columns)
    count = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    return rows.mapInArrow(tidy(lambda batches: _without(batches, text, last, count, min_chars)), rows.schema).drop(mark, copy)
