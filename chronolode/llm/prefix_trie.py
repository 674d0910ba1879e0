"""The trie of conversations that share their first turns, by ternary search trees over range shards.

1. Distinct turns (role, text) get ids in their order, a dictionary; from then on texts are read no more.
2. Conversations are cut into segments of ``SEGMENT`` turns. A segment hangs below the node where the one before it
   ends. A node's key is the exclusive or of marks of (depth, turn id), 128 bits, so the key where a segment starts
   comes from the totals of the earlier ones, and a conversation of any length is never one row.
3. Equal segments below one node are counted, then sorted by (start, turn ids) over ranges. Each range is cut into shards
   of about ``SHARD_TURNS`` turns. A shard's sequences are put into a ternary search tree, middle one first, then the
   middles of both halves and so on, which balances it; its nodes are walked in arrays, children before parents, to sum
   members, leaves and savings.
4. Nodes on the first and last path of a shard, and on paths that go on in a further segment, are boundary nodes: other
   shards may hold parts of them. Their parts are merged by key, and their sums are passed up in steps of doubled length.
   All other nodes are whole in their shard.
5. The SHA-256 of the ids that end in a node is one stream by definition; ids are joined to texts of some kilobytes where
   they lie, and only nodes whose ids lie in several ranges have these read in order by one task, which holds one at a time.

Keys with many rows (a turn, a conversation, children of a node) are joined by broadcast: those above a thousandth of
all turns, so at most a thousand.

Defined cases: rows without conv_id belong to no conversation; null role and text are empty; null turns come first, equal
turns are ordered by role, then text; equal rows are turns of their own; without rows there is no node, not even a
root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolode.llm.common import Batches, kept, text_of, tidy
from chronolode.operators.ranks import with_global_rank

SEGMENT = 64
SHARD_TURNS = 100_000
#: Bytes of joined ids in one row.
JOINED = 1 << 16
#: Keys with at most this many rows are never taken for hot.
FEW_ROWS = 10_000
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Turns:
    """A ternary search tree of sequences. Lists hold one entry per node; node 0 is where they start."""

    def __init__(self, key: tuple[int, int]):
        self.turn, self.low, self.high, self.down, self.parent = [None], [-1], [-1], [-1], [-1]
        self.size, self.members, self.least, self.depth, self.key = [None], [0], [None], [0], [key]

    def _add(self, parent: int, turn: int, size: int, marks: tuple[int, int]) -> int:
        a, b = self.key[parent]
        for column, value in (
            (self.turn, turn),
            (self.low, -1),
            (self.high, -1),
            (self.down, -1),
            (self.parent, parent),
            (self.size, size),
            (self.members, 0),
            (self.least, None),
            (self.depth, self.depth[parent] + 1),
            (self.key, (a ^ marks[0], b ^ marks[1])),
        ):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, turns: list[int], sizes: list[int], marks: list[tuple[int, int]], members: int, least: int) -> int:
        """Put a sequence in and return its last node."""
        at = 0
        for i, turn in enumerate(turns):
            found = self.down[at]
            if found < 0:
                found = self.down[at] = self._add(at, turn, sizes[i], marks[i])
            while turn != self.turn[found]:
                side = self.low if turn < self.turn[found] else self.high
                if side[found] < 0:
                    side[found] = self._add(at, turn, sizes[i], marks[i])
                found = side[found]
            at = found
        self.members[at] += members
        self.least[at] = least if self.least[at] is None else min(least, self.least[at])
        return at


def middles(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of the parts before and after it, and so on."""
    parts = [(0, n)]
    for low, high in parts:  # grows while it is read
        if low < high:
            middle = (low + high) // 2
            yield middle
            parts += [(low, middle), (middle + 1, high)]


_NODE = pa.schema(
    [(c, pa.int64()) for c in ("n1", "n2", "p1", "p2", "depth", "size", "n_convs", "conv_id", "n_children", "n_leaves", "saved", "parent_conv_id")]
    + [("open", pa.bool_())]
)
NODE_COLUMNS = ", ".join(f"{f.name} {'boolean' if f.type == pa.bool_() else 'long'}" for f in _NODE)


def shard_nodes(rows: list[dict], segment: int = SEGMENT) -> pa.RecordBatch:
    """Nodes of sorted distinct sequences that start in one node, each with what this shard knows of it.

    Boundary nodes (``open``) have the counts of their children and subtrees that are whole in the shard only.
    """
    first = rows[0]
    tree, ends = Turns((first["k1"], first["k2"])), [0] * len(rows)
    for i in middles(len(rows)):
        r = rows[i]
        ends[i] = tree.insert(r["ids"], r["sizes"], list(zip(r["m1"], r["m2"])), r["n"], r["least"])
    n = len(tree.turn)
    parent, members, least = tree.parent, tree.members, tree.least
    is_open, childless = [False] * n, [True] * n
    is_open[0] = True
    for end in [ends[0], ends[-1], *(e for e, r in zip(ends, rows) if r["goes_on"])]:
        while not is_open[end]:
            is_open[end] = True
            end = parent[end]
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):  # a node comes after its parent
        up = parent[i]
        members[up] += members[i]
        least[up] = least[i] if least[up] is None else min(least[i], least[up])
        childless[up] = False
        if not is_open[i]:
            children[up] += 1
            leaves[up] += leaves[i] + childless[i]
            saved[up] += saved[i] + (members[i] - 1) * tree.size[i]
            leaves[i] += childless[i]
            saved[i] += (members[i] - 1) * tree.size[i]
    start = first["s"] * segment
    if first["s"]:  # counted where the segment before ends
        members[0], least[0] = None, None
    else:
        tree.size[0] = 0
    ups = [None, *(tree.key[p] for p in parent[1:])]
    columns = [
        [k[0] for k in tree.key],
        [k[1] for k in tree.key],
        [u and u[0] for u in ups],
        [u and u[1] for u in ups],
        [start + d for d in tree.depth],
        tree.size,
        members,
        least,
        children,
        leaves,
        saved,
        [None if p < 0 or is_open[p] else least[p] for p in parent],
        is_open,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODE)], schema=_NODE)


def _sharded(segment: int, shard_turns: int):
    """Cut sorted sequences where their start changes, and before they outgrow a shard."""

    def run(batches: Batches) -> Batches:
        held, turns = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and (turns >= shard_turns or any(row[c] != held[0][c] for c in ("k1", "k2", "s"))):
                    yield shard_nodes(held, segment)
                    held, turns = [], 0
                held.append(row)
                turns += 1 + len(row["ids"])
        if held:
            yield shard_nodes(held, segment)

    return tidy(run)


def _lookup(rows: DataFrame, found: DataFrame, keys: list[str], count: str, most: int) -> DataFrame:
    """Inner join of ``rows`` to ``found``, unique by ``keys``, whose ``count`` is a key's number of rows.

    Keys of more than ``most`` rows, few by its choice, are broadcast.
    """
    hot = found.where(F.col(count) > most).drop(count)
    if hot.isEmpty():
        return rows.join(found.drop(count), keys)
    cold = rows.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(found.where(F.col(count) <= most).drop(count), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(cold)


def lent(conv_id: Column) -> Column:
    """Turns at most that the conversation takes from the first of its five, as the query's contract has it."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def _coded(conversations: DataFrame) -> tuple[DataFrame, int]:
    """Rows (conv_id, id, size, rank) in the order of conversations and turns, and the hot-key bound."""
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", text_of("role").alias("role"), text_of("text").alias("text")
    )
    exact = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    turns = turns.withColumn("code", F.unhex(F.substring(exact, 1, 32)))
    kinds = turns.groupBy("code").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"), F.count("*").alias("n"))
    ranked = with_global_rank(kinds, "role", "text", name="id")
    dictionary = kept(ranked.select("code", "id", F.octet_length("text").cast("long").alias("size"), "n"), "turns")
    most = max(FEW_ROWS, (dictionary.agg(F.sum("n")).first()[0] or 0) // 1000)
    coded = _lookup(turns.select("conv_id", "turn", "code"), dictionary, ["code"], "n", most)
    return with_global_rank(coded.drop("code"), "conv_id", "turn", "id"), most


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Turns (conv_id, at, id, size, total) of the rebuilt conversations, all conversations (conv_id, total), and the
    hot-key bound. Conversation c takes its first turns from c - c % 5 (as many as ``lent`` says) and the rest from itself.
    """
    placed, most = _coded(conversations)
    own = placed.groupBy("conv_id").agg(F.min("rank").alias("start"), F.count("*").alias("n"))
    takes = own.withColumn("take", lent(F.col("conv_id"))).withColumn("base", F.expr("try_subtract(conv_id, pmod(conv_id, 5L))"))
    lengths = own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    got = F.least("take", F.coalesce("n_base", F.lit(0)))
    convs = takes.join(lengths, "base", "left").withColumn("got", got)
    convs = kept(convs.withColumn("total", F.col("got") + F.greatest(F.col("n") - F.col("take"), F.lit(0))).drop("n_base"), "convs")
    here = kept(_lookup(placed, convs, ["conv_id"], "n", most).withColumn("at", F.col("rank") - F.col("start")), "placed")
    kept_own = here.where("at >= take").select("conv_id", (F.col("at") - F.col("take") + F.col("got")).alias("at"), "id", "size", "total")
    first = here.where("conv_id = base AND at < 8").select(F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"), "conv_id", "at", "id", "size")
    first = first.select(F.expr("try_add(conv_id, k)").alias("conv_id"), "at", "id", "size").where(F.col("at") < lent(F.col("conv_id")))
    taken = first.join(convs.select("conv_id", "total"), "conv_id")  # at most eight rows a conversation
    return kept_own.unionByName(taken.select(kept_own.columns)), convs.select("conv_id", "total"), most


def _segments(turns: DataFrame, convs: DataFrame, segment: int) -> DataFrame:
    """Segments (conv_id, s, goes_on, k1, k2, x1, x2, ids, sizes, m1, m2): k is the key of the node where they start."""
    marked = turns.withColumns(
        {"m1": F.xxhash64("at", "id"), "m2": F.xxhash64("id", "at", F.lit(1)), "s": F.expr(f"at div {segment}")}
    )
    grouped = marked.groupBy("conv_id", "s", "total").agg(
        F.bit_xor("m1").alias("x1"), F.bit_xor("m2").alias("x2"), F.sort_array(F.collect_list(F.struct("at", "id", "size", "m1", "m2"))).alias("t")
    )
    zero = F.lit(0).cast("long")
    cut = grouped.select("conv_id", "s", "total", "x1", "x2", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"), F.col("t.m1").alias("m1"), F.col("t.m2").alias("m2"))
    none = F.array().cast("array<long>")
    empty = convs.where("total = 0").select("conv_id", zero.alias("s"), "total", zero.alias("x1"), zero.alias("x2"), *(none.alias(c) for c in ("ids", "sizes", "m1", "m2")))
    cut = kept(cut.unionByName(empty), "segments")
    before = Window.partitionBy("conv_id").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    long = cut.where(F.col("total") > segment)
    starts = long.select("conv_id", "s", *(F.coalesce(F.bit_xor(f"x{i}").over(before), zero).alias(f"k{i}") for i in (1, 2)))
    rest = cut.where(F.col("total") <= segment).withColumns({"k1": zero, "k2": zero})
    return rest.unionByName(long.join(starts, ["conv_id", "s"])).withColumn("goes_on", F.col("total") > (F.col("s") + 1) * segment)


def _joined(size: int):
    """Ids in order as joined texts (n1, n2, first, ids, sha); a key that lies wholly in a range is hashed at once."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]

    def rows(parts: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*parts), types)], names=["n1", "n2", "first", "ids", "sha"])

    def run(batches: Batches) -> Batches:
        done: list[tuple] = []
        key, ids, first, length = None, [], 0, 0
        ranged = False  # whether more of the key may lie before or behind what is held

        def cut(whole: bool) -> None:
            if ids:
                text = ",".join(ids).encode()
                done.append((*key, first, None, hashlib.sha256(text).hexdigest()) if whole else (*key, first, text, None))
                ids.clear()

        for batch in batches:
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) != key:
                    cut(whole=not ranged)
                    ranged, key, length = key is None, (a, b), 0
                elif length >= size:
                    cut(whole=False)
                    ranged, length = True, 0
                if not ids:
                    first = conv
                ids.append(str(conv))
                length += len(ids[-1]) + 1
            if done:
                yield rows(done)
                done = []
        cut(whole=False)
        if done:
            yield rows(done)

    return tidy(run)


def _hashed(batches: Batches) -> Batches:
    """SHA-256 of each key's joined texts in order, holding one at a time."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([digest.hexdigest()])], names=["n1", "n2", "ends_sha256"])

    for batch in batches:
        for a, b, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)):
            if (a, b) != key:
                if key:
                    yield row()
                key, digest = (a, b), hashlib.sha256(ids.as_buffer())
            else:
                digest.update(b",")
                digest.update(ids.as_buffer())
    if key:
        yield row()


def _ends(segments: DataFrame, joined: int = JOINED) -> DataFrame:
    """(n1, n2, ends_sha256) for the nodes in which conversations end."""
    last = segments.where("NOT goes_on").select(F.expr("k1 ^ x1").alias("n1"), F.expr("k2 ^ x2").alias("n2"), "conv_id")
    ranged = last.repartitionByRange("n1", "n2", "conv_id").sortWithinPartitions("n1", "n2", "conv_id")
    parts = kept(ranged.mapInArrow(_joined(joined), "n1 long, n2 long, first long, ids binary, sha string"), "ends")
    split = parts.where("sha IS NULL").repartition("n1", "n2").sortWithinPartitions("n1", "n2", "first")
    hashed = split.mapInArrow(tidy(_hashed), "n1 long, n2 long, ends_sha256 string")
    return parts.where("sha IS NOT NULL").select("n1", "n2", F.col("sha").alias("ends_sha256")).unionByName(hashed)


def _merged(parts: DataFrame) -> DataFrame:
    """Boundary nodes from their parts, with whole sums: every round passes sums up twice as far as the one before."""
    whole = {"p1": F.max, "p2": F.max, "depth": F.max, "size": F.max, "n_convs": F.sum, "conv_id": F.min}
    whole |= {"n_children": F.sum, "n_leaves": F.sum, "saved": F.sum}
    nodes = kept(parts.groupBy("n1", "n2").agg(*(how(c).alias(c) for c, how in whole.items())), "boundary")
    more = nodes.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count("*").alias("more"))
    nodes = nodes.join(more, ["n1", "n2"], "left").withColumns(
        {
            "n_whole": F.col("n_children"),
            "n_children": F.col("n_children") + F.coalesce("more", F.lit(0)),
            "n_leaves": F.col("n_leaves") + (F.col("n_children") + F.coalesce("more", F.lit(0)) == 0).cast("long"),
            "saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("size"),
        }
    )
    nodes = kept(nodes.withColumns({"u1": F.col("p1"), "u2": F.col("p2")}).drop("more"), "boundary")
    while not nodes.where("u1 IS NOT NULL").isEmpty():
        gifts = nodes.where("u1 IS NOT NULL").groupBy("u1", "u2").agg(F.sum("n_leaves").alias("g_leaves"), F.sum("saved").alias("g_saved"))
        gifts = gifts.select(F.col("u1").alias("n1"), F.col("u2").alias("n2"), "g_leaves", "g_saved")
        ups = nodes.select(F.col("n1").alias("u1"), F.col("n2").alias("u2"), F.col("u1").alias("v1"), F.col("u2").alias("v2"))
        added = nodes.join(gifts, ["n1", "n2"], "left").join(ups, ["u1", "u2"], "left")
        sums = {c: F.col(c) + F.coalesce(g, F.lit(0)) for c, g in (("n_leaves", "g_leaves"), ("saved", "g_saved"))}
        added = added.withColumns(sums | {"u1": F.col("v1"), "u2": F.col("v2")})
        nodes = kept(added.select(nodes.columns), "boundary")
    return nodes.drop("u1", "u2")


def prefix_trie(turns: DataFrame, convs: DataFrame, most: int = FEW_ROWS, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes of the trie of conversations, one row each.

    ``turns`` (conv_id, at, id, size, total) has every turn once, numbered from 0 in its conversation of ``total`` turns;
    equal ids are equal turns. ``convs`` (conv_id, total) has every conversation once. Keys of more than ``most`` rows are
    joined by broadcast. Returns conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    segments = kept(_segments(turns, convs, segment), "started")
    arrays = ["ids", "sizes", "m1", "m2"]
    alike = segments.withColumn("long", F.size("ids")).groupBy("k1", "k2", "s", "x1", "x2", "long")
    sequences = alike.agg(
        F.any_value(F.struct(*arrays)).alias("a"), F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max("goes_on").alias("goes_on")
    ).select("k1", "k2", "s", "n", "least", "goes_on", "a.*")
    order = ["k1", "k2", "s", "ids"]
    nodes = sequences.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sharded(segment, shard_turns), NODE_COLUMNS)
    nodes = kept(nodes, "nodes")  # the ranges are drawn once: which nodes are boundary depends on them
    merged = _merged(nodes.where("open"))
    parents = merged.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("above"), F.col("n_children").alias("rows"))
    columns = ["n1", "n2", "p1", "p2", "depth", "n_convs", "conv_id", "n_children", "n_leaves", "saved"]
    whole = nodes.where("NOT open")
    below = whole.where("parent_conv_id IS NULL").select(columns).unionByName(merged.where("p1 IS NOT NULL").select(columns))
    found = whole.where("parent_conv_id IS NOT NULL").select(*columns, "parent_conv_id")
    found = found.unionByName(_lookup(below, parents, ["p1", "p2"], "rows", most).withColumnRenamed("above", "parent_conv_id"))
    found = found.unionByName(merged.where("p1 IS NULL").select(*columns, F.lit(None).cast("long").alias("parent_conv_id")))
    return found.join(_ends(segments), ["n1", "n2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
