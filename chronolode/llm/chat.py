"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its own text is under the
loss mask. Turns after the last assistant turn, and conversations without one, would be in no example; they follow as a
remainder, a formatted text without any trainable part.

The template writes a turn as ``### role: text </turn>`` and a line feed. Inside roles and texts a backslash, ``###`` and
``</turn>`` get a backslash in front (in roles a colon, too), so control strings of the template never stem from data
and every text can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TARGET = "assistant"
PART = 512

_TEXT_MARKS = re.compile(r"\\|###|</turn>")
_ROLE_MARKS = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_BODY = r"[^\\<]*(?:(?:\\(?:\\|###|</turn>|:)|<(?!/turn>))[^\\<]*)*"
_TURN = re.compile(rf"### ((?:[^\\:]|\\(?:\\|###|</turn>|:))*): ({_BODY}) </turn>\n", re.S)

EXAMPLES = "conv_id long, example long, target_turn long, text string, loss_start long, loss_end long, last boolean"


def escape(text: str) -> str:
    return _TEXT_MARKS.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn in the template, and where its text begins and ends there."""
    head = f"### {_ROLE_MARKS.sub(r'\\\g<0>', role)}: "
    body = escape(text)
    return f"{head}{body} </turn>\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; ValueError if it isn't one."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


class _Writer:
    """Gathers example rows and gives them out in batches of bounded size."""

    def __init__(self, names: list[str], types: list[pa.DataType], size: int = 8 << 20):
        self.schema, self.size = pa.schema(list(zip(names, types))), size
        self.rows, self.held = [], 0

    def add(self, row: tuple, weight: int) -> bool:
        self.rows.append(row)
        self.held += weight
        return self.held > self.size

    def batch(self) -> pa.RecordBatch:
        rows, self.rows, self.held = self.rows, [], 0
        columns = zip(*rows) if rows else [[] for _ in self.schema]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, self.schema.types)], schema=self.schema)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Examples of sorted rows (conv_id, part, own, turn, role, text, total): only own rows become examples."""
    i64, text = pa.int64(), pa.string()
    out = _Writer([f.split()[0] for f in EXAMPLES.split(", ")], [i64, i64, i64, text, i64, i64, pa.bool_()])
    here, prefix, size, example, seen = None, [], 0, 0, 0
    for batch in batches:
        for conv, part, own, turn, role, body, total in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if (conv, part) != here:
                here, prefix, size, example, seen = (conv, part), [], 0, 0, 0
            formatted, begin, end = format_turn(role, body)
            if len(prefix) > 64:
                prefix = ["".join(prefix)]
            prefix.append(formatted)
            seen += 1
            full = False
            if role == TARGET:
                if own:
                    full = out.add((conv, example, turn, "".join(prefix), size + begin, size + end, seen == total), size + len(formatted))
                example += 1
            elif seen == total:
                after = size + len(formatted)
                full = out.add((conv, example, None, "".join(prefix), after, after, True), after)
            size += len(formatted)
            if full:
                yield out.batch()
    yield out.batch()


def prefix_target_examples(conversations: DataFrame) -> DataFrame:
    """Examples of ``conversations`` (conv_id, turn, role, text), one row for each assistant turn.

    Columns: conv_id, example (from 0 in a conversation), target_turn, text (the formatted prefix and its target),
    loss_start and loss_end (code points of text under the loss mask: the target's text), last (this row holds all
    turns of its conversation). A remainder has no target_turn and an empty mask, and is last.

    Turns are ordered by turn (nulls first), then role and text. Null roles and texts are empty, rows of null conv_id
    are one conversation, and repeated rows are repeated turns. Further columns are ignored; an empty table gives no
    rows. A long conversation is split: rows of turns are also sent to the later parts of PART turns, so that the
    examples of one conversation are made by many tasks, each holding one prefix.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("part", F.coalesce(F.expr(f"turn div {PART}"), F.lit(-(1 << 40))))
    parts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    spans = parts.groupBy("conv_id").agg(F.collect_list("part").alias("parts"), F.sum("n").alias("total"))
    joined = rows.join(spans.withColumnRenamed("conv_id", "conv"), F.expr("conv_id <=> conv"))
    sent = joined.select("conv_id", "turn", "role", "text", "total", "part", F.explode(F.expr("filter(parts, p -> p >= part)")).alias("to"))
    sent = sent.select("conv_id", F.col("to").alias("part"), (F.col("to") == F.col("part")).alias("own"), "turn", "role", "text", "total")
    dealt = sent.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "turn", "role", "text")
    return dealt.mapInArrow(_expand, EXAMPLES)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long"


def _targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each example says, read from its text."""
    for batch in batches:
        conv, example, text, start, end, last = (batch.column(i).to_pylist() for i in range(6))
        target = [unescape(t[s:e]) for t, s, e in zip(text, start, end)]
        turns = [read_turns(t) if is_last else None for t, is_last in zip(text, last)]
        digest = [None if x is None else hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in x).encode("utf-8", "surrogatepass")).hexdigest() for x in turns]
        columns = [
            batch.column(0),
            batch.column(1),
            pa.array(target, pa.string()),
            pa.array([len(t) for t in text], pa.int64()),
            pa.array([None if x is None else len(x) for x in turns], pa.int64()),
            pa.array(digest, pa.string()),
            pa.array([s < len(t) for s, t in zip(start, text)], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "example", "target", "chars", "n_turns", "turns_sha256", "trains"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation of the sorted rows of _targets; texts are hashed one after another."""
    i64, text = pa.int64(), pa.string()
    out = _Writer([f.split()[0] for f in DIGESTS.split(", ")], [i64, i64, text, i64, text, i64, i64], 10_000)
    here, sha = object(), None
    for batch in batches:
        for conv, target, chars, n, turns, is_target in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if conv != here:
                if sha and out.add((here, n_turns, digest, loss_chars, sha.hexdigest(), formatted, examples), 1):
                    yield out.batch()
                here, sha, loss_chars, formatted, examples, n_turns, digest = conv, hashlib.sha256(), 0, 0, 0, None, None
            sha.update(target.encode("utf-8", "surrogatepass"))
            loss_chars += len(target)
            formatted += chars
            examples += is_target
            if n is not None:
                n_turns, digest = n, turns
    if sha:
        out.add((here, n_turns, digest, loss_chars, sha.hexdigest(), formatted, examples), 1)
    yield out.batch()


def read_back(examples: DataFrame) -> DataFrame:
    """Per conversation, what its examples say: turns, trained text and sizes, all read from the formatted texts."""
    said = examples.select("conv_id", "example", "text", "loss_start", "loss_end", "last").mapInArrow(
        _targets, "conv_id long, example long, target string, chars long, n_turns long, turns_sha256 string, trains boolean"
    )
    rows = said.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    return rows.select("conv_id", "target", "chars", "n_turns", "turns_sha256", F.col("trains").cast("int")).mapInArrow(_digest, DIGESTS)
