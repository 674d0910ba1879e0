"""Stored datasets and annotations."""

from pathlib import Path

from pyspark.sql import functions as F

from chronolode.sources.records import read_records, store_annotations, store_datasets, stored_calculations, upsert_records

DATASET = "name string, owner string, description string, blocks array<struct<begin_ns:bigint,end_ns:bigint,pvs:array<string>>>"
FRAME = "struct<name:string,ts:struct<kind:string,start_ns:bigint,period_ns:bigint,count:bigint,ts_ns:array<bigint>>,columns:array<struct<name:string,vals:array<double>>>>"
ANNOTATION = f"owner string, name string, comment string, dataset_ids array<string>, annotation_ids array<string>, calculations array<{FRAME}>"


def sets(spark, *names):
    return spark.createDataFrame([(n, "o", "d", [(1, 2, ["pv"])]) for n in names] + [("", "o", "d", [(1, 2, ["pv"])])], DATASET)


def test_a_repeated_creation_keeps_the_count(spark, tmp_path):
    path, notes = str(tmp_path / "d"), str(tmp_path / "a")
    assert read_records(spark, path) is None
    made = store_datasets(sets(spark, "a", "b"), path)
    assert sorted(r.status for r in made.collect()) == ["CREATED", "CREATED", "REJECT"]
    again = store_datasets(sets(spark, "b", "c", "c"), path)
    assert sorted(r.name for r in read_records(spark, path).collect()) == ["a", "b", "c"]
    ids = {r.name: r.dataset_id for r in again.collect()}
    assert ids["b"] == next(r.dataset_id for r in made.collect() if r.name == "b")

    frame = ("f", ("CLOCK", 5, 10, 2, None), [("x", [1.0, 2.0]), ("y", [3.0, 4.0])])
    rows = [("o", "n", "c", [ids["b"]], [], [frame]), ("o", "m", "c", ["unknown"], [], []), ("o", "k", "c", [ids["b"]], ["unknown"], None)]
    incoming = spark.createDataFrame(rows, ANNOTATION)
    for _ in range(2):
        got = {r.name: (r.status, r.message) for r in store_annotations(incoming, notes, path).collect()}
        assert got["n"] == ("CREATED", "") and got["m"][0] == got["k"][0] == "REJECT"
    stored = read_records(spark, notes)
    assert stored.count() == 1
    cells = {(r.column, r.ts_ns, r.value) for r in stored_calculations(stored).collect()}
    assert cells == {("x", 5, 1.0), ("x", 15, 2.0), ("y", 5, 3.0), ("y", 15, 4.0)}
    # an annotation may refer to one that is stored
    link = spark.createDataFrame([("o", "link", "c", [ids["b"]], [stored.first().annotation_id], [])], ANNOTATION)
    assert store_annotations(link, notes, path).first().status == "CREATED" and read_records(spark, notes).count() == 2


def test_upsert_rewrites_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(400).selectExpr("'k' || id AS id", "id AS v")
    upsert_records(rows, path, "id", 8)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}

    before = files()
    upsert_records(spark.createDataFrame([("k3", -1, "new"), (None, 5, "no key")], "id string, v bigint, more string"), path, "id", 8)
    after = files()
    assert len(before.items() - after.items()) == 1 and len(after) == len(before)
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    assert stored.count() == 400 and stored.where("v = -1").first().more == "new" and stored.agg(F.count_distinct("id")).first()[0] == 400
    upsert_records(rows.where("v < 0"), path, "id", 8)
    assert files() == after
