import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from chronolode.llm import prefix_trie
from chronolode.llm.queries import llm_queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_depth(row):
    return row[1], row[0], str(row)


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    given = {c: [(r, x) for _, r, x in sorted(t)] for c, t in turns.items()}
    built = {}
    for c in given:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(given.get(c - c % 5, [])[:h] + given[c][h:])
    nodes, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    for s in nodes:
        if s:
            children[s[:-1]] += 1
    for s, members in nodes.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not children[s]
            saved[s[:d]] += (len(members) - 1) * len(s[-1][1].encode()) if s else 0
    out = []
    for s, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(built[c]) == len(s)))
        above = min(nodes[s[:-1]]) if s else None
        out.append((min(members), len(s), above, len(members), children[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=by_depth)


def found(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=by_depth)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(llm_queries()["op11_prefix_trie"](spark, SF)) == brute(rows)


def given(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    return df.selectExpr("*", "1 AS id", "'x' AS at", "2 AS n", "3 AS total", "'y' AS code")


def odd_rows():
    """Shared beginnings, copies, a conversation that holds a third of all rows, ties, nulls, and an absent first of five."""
    rng = random.Random(6)
    rows = [(0, t, "user", f"hot {t // 3}") for t in range(150)] + [(1, t, "user", f"hot {t // 3}") for t in range(140)]
    for c in [*range(2, 60), *range(101, 140), -3, -5, 2**63 - 1]:
        if c == 20:
            continue
        n = rng.randrange(0, 12)
        rows += [(c, rng.choice([None, t, t, 3]), rng.choice([None, "user", "user"]), rng.choice(["", None, "a", "bé", "hello"])) for t in range(n)]
    rows += [(c, t, "system", "same") for c in range(200, 260) for t in range(3)]
    rows += [(21, 0, "user", "only"), (21, 0, "user", "only"), (None, 1, "user", "nobody"), (64, 1, "user", "w " * 500_000)]
    return rows


@pytest.mark.parametrize("segment, shard, joined, few", [(64, 100_000, 1 << 16, 10_000), (3, 40, 20, 5), (1, 1, 1, 1)])
def test_odd_conversations(spark, monkeypatch, segment, shard, joined, few):
    """Results do not depend on how segments, shards and joined ids are cut."""
    monkeypatch.setattr(prefix_trie, "FEW_ROWS", few)
    monkeypatch.setattr(prefix_trie._ends, "__defaults__", (joined,))
    rows = odd_rows()
    turns, convs, most = prefix_trie.rebuilt(given(spark, rows).repartition(5))
    got = found(prefix_trie.prefix_trie(turns, convs, most, segment, shard))
    assert got == brute(rows)
    assert any(r[3] >= 12 and r[7] != prefix_trie.NO_ENDS for r in got)


def test_search_tree_is_balanced():
    n = 1000
    order = list(prefix_trie.middles(n))
    assert sorted(order) == list(range(n))
    tree = prefix_trie.Turns((0, 0))
    for i in order:
        tree.insert([i], [1], [(i, i)], 1, i)

    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.low[at]), height(tree.high[at]))

    assert height(tree.down[0]) == 10


def test_nothing(spark):
    empty = given(spark, [(None, 1, "user", "x")])
    for df in (empty, empty.where("turn > 5")):
        assert prefix_trie.prefix_trie(*prefix_trie.rebuilt(df)).count() == 0
    one = found(prefix_trie.prefix_trie(*prefix_trie.rebuilt(given(spark, [(7, None, None, None)]))))
    assert one == brute([(7, None, None, None)])
