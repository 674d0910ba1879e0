"""Faults that show only on larger tables or odd values, made small."""

import os

import duckdb
import pytest
from compare import TABLES, compare
from pyspark.sql import functions as F

from chronolode.functions.names import FILE_NAME
from chronolode.operators import buckets, datasets, files, ingest, ranks, typed
from chronolode.queries import all_oracles, all_queries
from chronolode.queries import views as v
from chronolode.sources import store
from chronolode.streaming import jobs as streaming

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("join", [datasets.dataset_buckets, datasets.dataset_resolve])
def test_counted_sides_beyond_the_limit_are_not_broadcast(spark, join, monkeypatch):
    """Spark's own estimate of a checkpointed table may not bring back the broadcast that its count forbids."""
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", -1)
    right = v.v_buckets(spark, SF) if join is datasets.dataset_buckets else v.v_samples(spark, SF)
    plan = join(v.v_datasets(spark, SF), right)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [pv" in plan and "BroadcastHashJoin [pv" not in plan


def events(spark, path, rows):
    """The smallest tables with other events: (event_id, seconds, user_id, event_type, value)."""
    for name in os.listdir(SF):
        if name != "events.parquet":
            os.symlink(f"{SF}/{name}", path / name)
    made = spark.createDataFrame(rows, "event_id long, s long, user_id long, event_type string, value double")
    made = made.selectExpr("event_id", "CAST(timestamp_seconds(1704067200 + s) AS TIMESTAMP_NTZ) AS ts", "user_id", "event_type", "value", "'{\"k\": 1}' AS props")
    made.write.parquet(str(path / "events.parquet"))
    return str(path)


def differences(spark, name, sf):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet{'/*.parquet' * os.path.isdir(f'{sf}/{table}.parquet')}'")
    return compare(spark, con, name, all_queries()[name], all_oracles()[name], sf)


def test_ts_valid_of_instants_beyond_bigint(spark, tmp_path):
    sf = events(spark, tmp_path, [(i, 0, 1, "view", 1.0) for i in (0, 6, 7, 5_116_000, 5_999_999, 10**12)])
    found = {r.event_id: (r.low, r.high) for r in all_queries()["ts_valid"](spark, sf).collect()}
    assert found[0] == (False, True) and found[6] == (True, False) and found[5_999_999] == (True, False)
    assert not found[10**12][1]


#: Samples of one signal at one instant with different values, NaN (event 17) and infinity (event 53) among them.
TIED = [(e, s, 1, "view", float(e * 7 % 5)) for s in (5, 90_000) for e in (34, 1, 53, 17, 2, 3, 68)] + [(51, 7, 1, "view", 1.0), (4, 9, 2, "click", 2.0)]


@pytest.mark.parametrize("name", ["column_merge", "expand_timestamps", "table_rows", "table_to_map"])
def test_samples_of_one_instant_match_sql(spark, tmp_path, name):
    assert differences(spark, name, events(spark, tmp_path, TIED)) == ""


def test_equal_samples_of_a_dataset_match_sql(spark, tmp_path):
    """Samples equal in all columns, the event's id too, are all in a dataset, and each once though blocks overlap."""
    rows = [(e, 3_600 * e, u, "view", 1.0) for e in range(0, 200, 7) for u in (1, 5) for _ in range(1 + e % 3)]
    assert differences(spark, "dataset_resolve", events(spark, tmp_path, rows)) == ""


def test_numbers_beyond_64_bits(spark, tmp_path):
    """Stated as ULONG they are missing, and by themselves they are no ULONG; they used to wrap around."""
    rows = [(e, e % 1000, 0, "error", 1.0) for e in (0, 2, 551_614, 551_616, 551_618)]
    assert differences(spark, "typed_samples", events(spark, tmp_path, rows)) == ""
    texts = ["18446744073709551615", "18446744073709551616", "-18446744073709551616"]
    df = spark.createDataFrame([(f"p{i}", 1, t) for i, t in enumerate(texts)], "pv string, ts_ns long, t string")
    samples = df.selectExpr("pv", "ts_ns", "CAST(CAST(t AS DECIMAL(20,0)) AS VARIANT) AS value")
    found = typed.typed_samples(typed.typed_buckets(samples), "pv").select("pv", "data_type", F.to_json("value").alias("v")).collect()
    assert {r.pv: (r.data_type, float(r.v)) for r in found} == {"p0": ("ULONG", 2.0**64), "p1": ("DOUBLE", 2.0**64), "p2": ("DOUBLE", -(2.0**64))}


def test_requests_of_one_id_in_one_batch_or_two(spark, tmp_path):
    """Equal requests count once wherever they arrive; other contents under the same id are other requests."""
    requests = v.v_requests(spark, SF).where("provider_id LIKE 'prov-%'").limit(30).localCheckpoint()
    other = requests.withColumn("columns", F.transform("columns", lambda c: c.withField("name", F.concat(c["name"], F.lit("_B")))))
    late = requests.withColumn("received_ns", F.col("received_ns") + 5)
    want = None
    for files, name in ((1, "one"), (3, "three")):
        source, out = str(tmp_path / f"in-{name}"), str(tmp_path / f"out-{name}")
        for part in (requests, other, late):
            part.coalesce(1).write.mode("append").parquet(source)
        for attempt in range(2):  # the second run has lost its progress
            stream = streaming.request_stream(spark, source, 4 - files)
            streaming.stream_ingest(stream, v.v_providers(spark, SF), out, str(tmp_path / f"c-{name}-{attempt}"), True).awaitTermination()
        found, status = streaming.ingested(spark, out)
        assert status.count() == 60 and found.count() == 2 * status.where("status = 'SUCCESS'").count()
        rows = sorted((r.request_id, r.status, *sorted(r.bucket_ids)) for r in status.collect())
        assert want is None or rows == want
        want = rows


@pytest.mark.parametrize("name", ["stream_ingest", "stream_status", "stream_resume"])
def test_streams_match_sql_over_several_batches(spark, tmp_path, name):
    """One line item is there twice, two share an id, and every batch is one file."""
    for table in os.listdir(SF):
        if table != "lineitem.parquet":
            os.symlink(f"{SF}/{table}", tmp_path / table)
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey % 29 = 0 OR l_suppkey < 5").limit(60).localCheckpoint()
    other = rows.withColumn("l_extendedprice", F.col("l_extendedprice") + 1)
    for k, part in enumerate((rows, other, rows, rows.limit(9), rows.limit(9))):
        part.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet" / f"part={k}"))
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = "/*/*.parquet' , hive_partitioning = false)" if table == "lineitem" else "')"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet{path}")
    assert compare(spark, con, name, all_queries()[name], all_oracles()[name], str(tmp_path)) == ""


def test_one_provider_of_most_requests(spark, monkeypatch):
    """Requests stay where they are while providers are few; beyond, those of one provider go to several places."""
    requests, providers = v.v_requests(spark, SF), v.v_providers(spark, SF)
    plan = ingest.validate_provider(requests, providers)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    few = {(r.request_id, r.provider_id, r.known) for r in ingest.validate_provider(requests, providers).select("request_id", "provider_id", "known").collect()}
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", -1)
    many = ingest.validate_provider(requests, providers)
    assert "hashpartitioning(provider_id" in (plan := many._jdf.queryExecution().executedPlan().toString()) and "__place" in plan.split("hashpartitioning(provider_id")[1][:40]
    assert many.count() == requests.count()
    assert {(r.request_id, r.provider_id, r.known) for r in many.select("request_id", "provider_id", "known").collect()} == few


@pytest.mark.parametrize("folder", ["day", "month"])
def test_requests_are_shuffled_before_their_columns_are_cut(spark, tmp_path, folder, monkeypatch):
    """What the columns of a request share travels once; the store is the same."""
    requests, plans = v.v_requests(spark, SF).where("pmod(xxhash64(request_id), 80) = 0"), []
    real = store._write
    monkeypatch.setattr(store, "_write", lambda rows, *rest: (plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), real(rows, *rest)))
    new = store.write_buckets(requests, str(tmp_path / "a"), "overwrite", folder)
    store.save_buckets(store.consistent(buckets.request_buckets(requests)), str(tmp_path / "b"), "overwrite", folder)
    old = store.read_buckets(spark, str(tmp_path / "b"))
    assert plans[0].index("Generate explode") < plans[0].index("RebalancePartitions")  # what a plan does last stands first
    keys = ["day", "bucket_id", "provider_id", "request_id", "first_ns", "last_ns", "sample_count", "vals", "tags", "event"]
    assert new.count() == old.count() > 0 and new.select(*keys).exceptAll(old.select(*keys)).count() == 0
    assert new.select(folder, "span_days").distinct().exceptAll(old.select(folder, "span_days").distinct()).count() == 0


def test_file_names_are_matched_once(spark):
    """The parse of a file's name may not become part of the aggregation, which would repeat it for every field."""
    rows = [(p, "X") for p in ("/d/CU_HXR_20240230_195500_P1.h5\n", "CU_HXR_20240229_195500\n", "/d/CU_HXR_20240229_196000.h5", "raw dump") for _ in range(2)]
    found = files.file_metadata_distinct(spark.createDataFrame(rows, "path string, signal_name string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(FILE_NAME) == 1
    got = {r.path: (r.origin, r.time, r.project, r.valid, r.signals) for r in found.collect()}
    assert got == {
        "/d/CU_HXR_20240230_195500_P1.h5\n": ("CU", "195500", "P1", False, 2),
        "CU_HXR_20240229_195500\n": ("CU", "195500", "default", True, 2),
        "/d/CU_HXR_20240229_196000.h5": ("CU", "196000", "default", False, 2),
        "raw dump": ("unknown", "unknown", "unknown", False, 2),
    }


def test_streams_keep_little_beside_their_rows(spark, tmp_path, monkeypatch):
    """Repeated requests are looked for by numbers, not by the texts of their keys, and stored files are dense."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    requests = v.v_requests(spark, SF).where("provider_id LIKE 'prov-%'").limit(30)
    nobody = requests.limit(3).withColumn("provider_id", F.lit(None).cast("string"))  # equal ones without provider all stay
    for mode in ("overwrite", "append"):
        requests.unionByName(nobody).unionByName(nobody).coalesce(1).write.mode(mode).parquet(source)
    plans, real = [], streaming.cut_lineage

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(streaming, "cut_lineage", seen)
    stream = streaming.request_stream(spark, source, 1)
    streaming.stream_ingest(stream, v.v_providers(spark, SF), out, str(tmp_path / "c"), True).awaitTermination()
    in_batches = len(plans)
    status = streaming.ingested_status(spark, out)
    assert [p.split("hashpartitioning(")[1].split("#")[0] for p in plans[:in_batches]] == ["delivery"] * 2
    keys, firsts = plans[in_batches:]  # those of the status rows alone
    assert "hashpartitioning(__key#" in keys and "hashpartitioning(provider_id#" in firsts
    assert status.count() == 30 + 12 and status.columns[0] == "status_id"
    assert status.where("provider_id IS NOT NULL").select("status_id").distinct().count() == 30
    assert streaming.ingested_buckets(spark, out).count() == 2 * status.where("status = 'SUCCESS'").count()
    assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / "out").rglob("*.parquet"))


def test_stream_answers_name_all_requests(spark):
    """The lists of received and rejected ids of a stream, equal ids and requests without id too, in bounded rows."""
    day = 86_400 * 10**9
    rows = [("s", "b", 2, "ACCEPTED"), ("s", "a", 2, "REJECTED"), ("s", "c", 1, "ACCEPTED"), ("s", "c", 1, "ACCEPTED"), ("s", "d", day, "ACCEPTED")]
    rows += [("t", "e", 5, "ACCEPTED"), (None, None, 3, "REJECTED")]
    made = spark.createDataFrame(rows, "stream_id string, request_id string, received_ns long, status string")
    found = {(r.stream_id, str(r.day)): tuple(r)[2:] for r in ingest.ingest_stream_summary(made).collect()}
    assert found == {
        ("s", "1970-01-01"): (["c", "c", "a", "b"], ["a"], 5, 1, 4, True),
        ("s", "1970-01-02"): (["d"], [], 5, 1, 4, True),
        ("t", "1970-01-01"): (["e"], [], 1, 0, 1, False),
        (None, "1970-01-01"): ([None], [None], 1, 1, 0, True),
    }
