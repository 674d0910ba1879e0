"""Operators that split hot groups, against brute force on small skewed data."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from chronolode.operators import buckets, datasets, median, ranks, stats
from chronolode.operators.axis import expand_timestamps
from chronolode.plans.jobs import statistics_of_window
from chronolode.schema import NS_PER_DAY, NS_PER_SEC

DAY = NS_PER_DAY


def skewed(seed=1, n=3000):
    """(pv, ts, value): one signal holds most rows, many of them equal."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        pv = "hot" if rng.random() < 0.7 else f"p{rng.randrange(20)}"
        value = rng.choice([0.0, -0.0, 1.5, -3.25, rng.gauss(0, 1e6), rng.gauss(0, 1e-6), float("inf"), float("-inf")])
        rows.append((pv, i * 7 * NS_PER_SEC, value))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "pv string, ts_ns bigint, value double")


@pytest.mark.parametrize("small_rest", [0, 3, 100_000])
def test_radix_median(spark, small_rest):
    rows = [r for r in skewed() if abs(r[2]) != float("inf")]
    by_pv = {}
    for pv, _, value in rows:
        by_pv.setdefault(pv, []).append(value)
    got = {r.pv: r["median"] for r in median.radix_median(frame(spark, rows), small_rest=small_rest).collect()}
    assert got.keys() == by_pv.keys()
    for pv, values in by_pv.items():
        assert got[pv] == pytest.approx(statistics.median(values), rel=1e-12)


def test_statistics_split_between_hot_and_usual(spark):
    rows = skewed(2)
    together = stats.pv_statistics(frame(spark, rows)).orderBy("pv").collect()
    split = stats.pv_statistics(frame(spark, rows), hot_samples=100).orderBy("pv").collect()
    assert [(r.pv, r["count"], r["min"], r["max"]) for r in together] == [(r.pv, r["count"], r["min"], r["max"]) for r in split]
    for a, b in zip(together, split):
        assert a["median"] == pytest.approx(b["median"], nan_ok=True)


@pytest.mark.parametrize("n", [1, 2, 3, 999, 3999, 4000, 4001, 30_000])
def test_median_of_any_size(spark, n):
    """The sketch knows small groups exactly and brackets large ones, over many partitions and with ties."""
    rng = random.Random(n)
    rows = [("spread", 0, rng.gauss(0, 1)) for _ in range(n)] + [("tied", 0, float(rng.randrange(5))) for _ in range(n)]
    rows += [("sorted", 0, float(i)) for i in range(n)] + [("steps", 0, float(i // 700)) for i in range(n)]
    df = frame(spark, rows).repartition(11)
    want = {pv: statistics.median([v for p, _, v in rows if p == pv]) for pv in ("spread", "tied", "sorted", "steps")}
    for part in (df, df.coalesce(1)):
        assert {r.pv: r["median"] for r in median.radix_median(part).collect()} == pytest.approx(want, rel=1e-14)


def test_statistics_scan_at_most_twice(spark, tmp_path, monkeypatch):
    rows = skewed(4, 20_000)
    frame(spark, rows).write.parquet(str(tmp_path / "s"))
    plans = []
    real = median.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(median, "cut_lineage", seen)
    out = stats.pv_statistics(spark.read.parquet(str(tmp_path / "s")))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert [p.count("FileScan parquet") for p in plans] == [1, 1] and "reflect" not in plans[1]
    by_pv = {}
    for pv, _, value in rows:
        by_pv.setdefault(pv, []).append(value)
    assert {r.pv: r["median"] for r in out.collect()} == pytest.approx({k: statistics.median(v) for k, v in by_pv.items()}, nan_ok=True)


def test_global_rank_with_ties(spark):
    rng = random.Random(3)
    rows = [(5 if rng.random() < 0.5 else rng.randrange(100), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, id int").repartition(7)
    got = ranks.with_global_rank(df, "k", "id").orderBy("rank").collect()
    assert [(r.k, r.id) for r in got] == sorted(rows)
    assert [r["rank"] for r in got] == list(range(1, 2001))


def test_global_rank_of_nothing(spark):
    assert ranks.with_global_rank(spark.range(0), "id").count() == 0


def test_global_rank_spreads_copies(spark):
    """Rows equal in all keys get different ranks and do not all meet in one partition."""
    df = spark.createDataFrame([(1,)] * 4000 + [(i,) for i in range(50)], "k int").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would join such small parts
    try:
        ranked = ranks.with_global_rank(df, "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 4051))
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3000


@pytest.mark.parametrize("max_samples", [1_000_000, 50, 1])
def test_packing_keeps_all(spark, max_samples):
    rows = skewed(4) + [("burst", 40 * NS_PER_SEC + i % 3, float(i)) for i in range(400)]
    rows += [("copies", 90 * NS_PER_SEC, 1.25)] * 500
    packed = buckets.pack_buckets(frame(spark, rows), max_samples)
    found = packed.select("bucket_id", "pv", "first_ns", "last_ns", "sample_count").collect()
    assert max(r.sample_count for r in found) <= max_samples
    assert len({r.bucket_id for r in found}) == len(found)
    for a, b in zip(ordered := sorted(found, key=lambda r: (r.pv, r.first_ns, r.bucket_id)), ordered[1:]):
        assert a.pv != b.pv or a.last_ns <= b.first_ns  # no overlap in time
    back = expand_timestamps(packed, "pv").select("pv", "ts_ns", "value").collect()
    assert sorted(map(tuple, back), key=str) == sorted(rows, key=str)


def test_pages_partition_the_result(spark):
    packed = buckets.pack_buckets(frame(spark, skewed(5)), 40).select(*buckets.PAGE_ORDER)
    pages = buckets.query_pages(packed, 7).collect()
    keys = sorted(tuple(r)[:3] for r in pages)
    assert sorted(tuple(r) for r in packed.collect()) == keys
    assert {r.page for r in pages} == set(range(1, -(-len(keys) // 7) + 1))
    walked, after = [], None
    while step := [tuple(r) for r in buckets.next_page(packed, 7, after).collect()]:
        walked += step
        after = step[-1]
    assert walked == keys


@pytest.mark.parametrize("max_samples", [1_000_000, 7])
def test_column_merge_order(spark, max_samples):
    rows = skewed(6)
    merged = buckets.column_merge(buckets.pack_buckets(frame(spark, rows), max_samples)).collect()
    by_pv = {}
    for pv, _, value in sorted(rows, key=lambda r: (r[0], r[1])):
        by_pv.setdefault(pv, []).append(value)
    for pv, values in by_pv.items():
        assert [r.value for r in sorted((r for r in merged if r.pv == pv), key=lambda r: r.pos)] == values


def brute_resolve(blocks, rows):
    return sorted(
        {(d, pv, ts) for d, parts in blocks for begin, end, pvs in parts for pv, ts, _ in rows if pv in pvs and begin <= ts < end}
    )


def test_cover_is_whole_and_small(spark):
    rng = random.Random(11)
    spans = [(b, b + rng.choice([1, DAY // 3, DAY, rng.randrange(1, 40_000) * DAY])) for b in (rng.randrange(-9000, 9000) * DAY + rng.choice([0, 1, DAY // 2]) for _ in range(400))]
    df = spark.createDataFrame(spans, "b bigint, e bigint").select("b", "e", datasets.cover(F.col("b"), F.col("e")).alias("c"))
    for r in df.collect():
        days = sorted(d for c in r.c for d in range(c.cell * 8**c["size"], (c.cell + 1) * 8**c["size"]))
        assert days == list(range(r.b // DAY, (r.e - 1) // DAY + 1)) and len(r.c) <= 14 * 7


@pytest.mark.parametrize("factor", [8, 2, 3])
def test_dataset_blocks_overlap_and_touch(spark, factor, monkeypatch):
    monkeypatch.setattr(datasets, "CELL_FACTOR", factor)
    rows = [("hot" if i % 3 else "p1", i * DAY // 10, float(i)) for i in range(200)]
    blocks = [
        (1, [(0, 3 * DAY, ["hot"]), (2 * DAY, 5 * DAY, ["hot", "p1"]), (5 * DAY, 6 * DAY, ["hot"])]),
        (2, [(0, 100 * DAY, ["hot"]), (0, 100 * DAY, ["hot"]), (DAY, 2 * DAY, ["hot", "p1"])]),
        (3, [(4 * DAY, 4 * DAY, ["hot"]), (9 * DAY, 8 * DAY, ["p1"])]),
        (4, [(0, DAY // 10 + 1, ["p1", "hot"]), (19 * DAY, 20 * DAY, ["p1"])]),
    ]
    schema = "dataset_id int, blocks array<struct<begin_ns:bigint,end_ns:bigint,pvs:array<string>>>"
    sets, samples = spark.createDataFrame(blocks, schema), frame(spark, rows)
    got = datasets.dataset_resolve(sets, samples).collect()
    assert sorted((r.dataset_id, r.pv, r.ts_ns) for r in got) == brute_resolve(blocks, rows)

    packed = buckets.pack_buckets(samples)
    found = datasets.dataset_buckets(sets, packed).collect()
    expected = sorted(
        {
            (d, b.bucket_id)
            for d, parts in blocks
            for begin, end, pvs in parts
            for b in packed.collect()
            if b.pv in pvs and begin < end and b.first_ns < end and b.last_ns >= begin
        }
    )
    assert sorted((r.dataset_id, r.bucket_id) for r in found) == expected


def test_window_statistics_from_a_store(spark, tmp_path):
    from chronolode.sources.store import save_buckets

    rows = [r for r in skewed(7) if abs(r[2]) != float("inf")]
    path = str(tmp_path / "store")
    save_buckets(buckets.pack_buckets(frame(spark, rows)), path)
    begin, end = 1000 * NS_PER_SEC, 15_000 * NS_PER_SEC
    got = {r.pv: (r["count"], r["median"]) for r in statistics_of_window(spark.read.parquet(path), begin, end).collect()}
    inside = {}
    for pv, ts, value in rows:
        if begin <= ts < end:
            inside.setdefault(pv, []).append(value)
    assert got.keys() == inside.keys()
    for pv, values in inside.items():
        assert got[pv][0] == len(values) and got[pv][1] == pytest.approx(statistics.median(values))
