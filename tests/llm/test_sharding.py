from collections import Counter

from helpers import documents

from chronolode.llm import sharding
from chronolode.llm.sharding import external_shuffle, record_size, write_shards

ROWS = [(i, None if i % 17 == 0 else "x" * (i % 90)) for i in range(1, 400)] + [(None, "no id"), (None, None), (5, "twice"), (5, "twice"), (6, "y" * 300_000)]


def test_rows_law_and_slots(spark):
    docs = documents(spark, ROWS, extra=True)
    rows = external_shuffle(docs, 7, bucket_bytes=20_000).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(ROWS)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    assert all(r.bucket == 1 and r.component_id == 2 and r.tags == {"a": 1} for r in rows)


def test_same_whatever_the_partitions(spark):
    docs = documents(spark, ROWS)
    key = lambda r: (str(r.doc_id), str(r.text))
    places = [sorted((key(r), r.shard, r.slot) for r in external_shuffle(d, 5, bucket_bytes=30_000).collect()) for d in (docs.repartition(1), docs.repartition(6, "text"))]
    assert places[0] == places[1]
    assert places[0] != sorted((key(r), r.shard, r.slot) for r in external_shuffle(docs, 5, seed=1, bucket_bytes=30_000).collect())


def test_order_is_mixed(spark):
    rows = external_shuffle(documents(spark, [(i, "t") for i in range(2000)]), 4, bucket_bytes=4_000).collect()
    ids = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert sum(abs(a - b) == 1 for a, b in zip(ids, ids[1:])) < 20
    assert all(400 < sum(i < 1000 for i in ids[k : k + 1000]) < 600 for k in (0, 1000))


def test_fewer_rows_than_shards_and_none(spark):
    rows = external_shuffle(documents(spark, [(1, "a"), (2, None)]), 40).collect()
    assert sorted(r.slot for r in rows) == [0, 0] and len({r.shard for r in rows}) == 2
    assert external_shuffle(documents(spark, []), 40).collect() == []


def test_size_and_files(spark, tmp_path):
    docs = documents(spark, [(1, "é"), (2, None)])
    assert {r.doc_id: r.s for r in docs.select("doc_id", record_size().alias("s")).collect()} == {1: 18, 2: 16}
    path = str(tmp_path / "shards")
    shuffled = external_shuffle(documents(spark, ROWS), 3)
    for _ in range(2):
        write_shards(shuffled, path)
    back = spark.read.parquet(path)
    assert back.count() == len(ROWS)
    assert sharding.SEED
