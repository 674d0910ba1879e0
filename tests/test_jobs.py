"""Whole jobs: import, archive import, store, export, streaming, listings."""

import os

import pytest
from pyspark.sql import functions as F

from chronolode import schema
from chronolode.operators import annotations, buckets, datasets, files, ingest, spatial, tables
from chronolode.plans import jobs
from chronolode.queries import views as v
from chronolode.sources import catalog, dictionaries, export, store
from chronolode.streaming import jobs as streaming

SF = "/root/testdata/sf0.001"
S = schema.NS_PER_SEC


def raw(spark):
    def row(path, name, size=4096, objects=5, dims=(4,), secs=(10, 11, 12, 13), nanos=(1, 2, 3, 4), vals=(1.0, 2.0, 3.0, 4.0)):
        return (path, size, objects, name, None, None, list(dims), list(secs), None if nanos is None else list(nanos), list(vals))

    rows = [
        row("/d/a.h5", "KLYS_LI23_1_AMPL"),
        row("/d/a.h5", "secondsPastEpoch"),
        row("/d/a.h5", "QUAD_LI23_1_BACT", dims=(2, 4), vals=range(8)),
        row("/d/a.h5", "BPMS_LI23_1_X", dims=(3,), vals=(1.0, 2.0, 3.0)),
        row("/d/a.h5", "BPMS_LI23_2_X", nanos=(1, 2)),
        row("/d/a.h5", "BPMS_LI23_3_X", nanos=None),
        row("/d/small.h5", "KLYS_LI23_1_AMPL", size=10),
        row("/d/many.h5", "KLYS_LI23_1_AMPL", objects=10_001),
        row("/d/done.h5", "KLYS_LI23_1_AMPL"),
    ]
    data = [(*r[:9], [float(x) for x in r[9]]) for r in rows]
    return spark.createDataFrame(data, schema.RAW_SIGNALS)


def test_import(spark):
    done = spark.createDataFrame([("/d/done.h5",)], "path string")
    limits = {"min_file_bytes": 1024, "max_file_bytes": 10**10, "max_objects": 10_000, "max_samples": 10**7}
    requests = jobs.import_requests(raw(spark), "prov-1", 99, done, **limits)
    rejects = {(r.path, r.signal_name): r.reason for r in jobs.import_rejects(raw(spark), done, **limits).collect()}
    assert rejects == {
        ("/d/a.h5", "secondsPastEpoch"): "time, not a signal",
        ("/d/a.h5", "BPMS_LI23_1_X"): "no dimension fits the time axis",
        ("/d/a.h5", "BPMS_LI23_2_X"): "seconds and nanoseconds differ",
        ("/d/small.h5", "KLYS_LI23_1_AMPL"): "too small",
        ("/d/many.h5", "KLYS_LI23_1_AMPL"): "too many objects",
        ("/d/done.h5", "KLYS_LI23_1_AMPL"): "file imported before",
    }
    assert requests.count() + len(rejects) == raw(spark).count()
    assert jobs.import_requests(raw(spark), "prov-1", 99).count() == 6  # without limits or a manifest
    assert set(requests.columns) == set(schema.INGEST_REQUESTS.names)
    got = {r["columns"][0].name: r for r in requests.collect()}
    assert sorted(got) == ["BPMS_LI23_3_X", "KLYS_LI23_1_AMPL", "QUAD_LI23_1_BACT"]
    klys = got["KLYS_LI23_1_AMPL"]
    assert tuple(klys.ts)[:4] == ("CLOCK", 10 * S + 1, S + 1, 4)
    assert klys.event.stop_ns == 13 * S + 4
    assert got["QUAD_LI23_1_BACT"]["columns"][0].vals == [0.0, 1.0, 2.0, 3.0]
    assert got["BPMS_LI23_3_X"].ts.start_ns == 10 * S
    assert klys.tags == ["h5_data", "accelerator_data", "production", "all_valid"]
    assert klys.attributes["data_quality_ratio"] == "1.000000" and klys.attributes["device_area"] == "LI23"
    assert klys.attributes["beam_line"] == "a" and klys.attributes["acquisition_time"] == "unknown_time"
    providers = spark.createDataFrame([("prov-1",)], "provider_id string")
    checked = ingest.validate_requests(requests, providers)
    assert {r.status for r in checked.collect()} == {"ACCEPTED"}


def test_archive_import(spark):
    requests = jobs.archive_requests(v.v_archive_json(spark, SF), "prov-1", 7)
    rows = requests.collect()
    points = [r for r in v.v_archive_json(spark, SF).collect() if r.user_id % 7]
    assert len(rows) == len(points)
    one = next(r for r in rows if r["columns"][0].name.endswith(":1:TEMP"))
    vals = one["columns"][0].vals
    assert vals[0] == 1.0 and vals[1] != vals[1] and vals[2] != vals[2]  # bad value, then invalid alarm
    assert one.attributes["epics_egu"] == "C" and one.attributes["data_valid_percentage"] == "33.333333"
    assert one.attributes["data_alarm_count"] == "2" and one.attributes["has_enums"] == "false"
    assert one.tags == ["archiver_data", "epics_data", "device_IOC", "project_epics_archive", "has_alarms"]
    assert tuple(one.ts)[:4] == ("CLOCK", 1_700_000_000 * S + 5, 121 * S // 2, 3)
    plan = requests._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange hashpartitioning(pv" not in plan and plan.count("tryParseJson") + plan.count("try_parse_json") <= 1
    listed = jobs.archive_requests(v.v_archive_json(spark, SF), "prov-1", 7, clock=False).first().ts
    assert (listed.kind, listed.period_ns, len(listed.ts_ns)) == ("LIST", 0, 3)


@pytest.mark.parametrize("payload", ["[]", "{}", "[5]", "null", "nonsense", '{"meta": {}}', ""])
def test_bad_archive_answers(spark, payload):
    from chronolode.sources.archive_json import archive_json

    df = spark.createDataFrame([(payload,)], "payload string")
    row = archive_json(df).first()
    assert row.error and row.ts_ns is None


def test_archive_points(spark):
    from chronolode.sources.archive_json import archive_json

    text = '[{"meta":{"name":"A:B"},"data":[{"secs":1,"nanos":2,"val":"3"},{"secs":1,"nanos":3,"val":4,"fields":{"f":"g"}},{"secs":2}]},{"meta":{"name":"second"}}]'
    rows = archive_json(spark.createDataFrame([(text,)], "payload string")).orderBy("ts_ns").collect()
    assert [r.pv for r in rows] == ["A:B"] * 3
    assert rows[0].val != rows[0].val and rows[1].val == 4.0 and rows[2].val == 0.0
    assert rows[1].fields == {"f": "g"} and rows[2].severity == 0


def test_store_round_trip_and_compaction(spark, tmp_path):
    path = str(tmp_path / "s")
    requests = v.v_requests(spark, SF).limit(50)
    stored = store.write_buckets(requests, path)
    whole = requests.where("ts.count = 4").count()
    assert stored.count() == 2 * whole
    day = stored.select("day").orderBy("day").first().day
    store.compact_day(spark, path, str(tmp_path / "c"), str(day), 1)
    assert store.read_buckets(spark, str(tmp_path / "c")).count() == stored.where(F.col("day") == F.lit(day)).count()


def test_export_formats(spark, tmp_path):
    from chronolode.sources.export import export_data

    sets, samples = v.v_datasets(spark, SF), v.v_samples(spark, SF)
    packed = buckets.pack_buckets(samples)
    assert export_data(sets, samples, packed, 9, None, str(tmp_path / "n"))[1].startswith("REJECTED")
    assert export_data(sets, samples, packed, -1, "csv", str(tmp_path / "n"))[1].startswith("REJECTED")
    path, fault = export_data(sets, samples, packed, 9, "bucketed", str(tmp_path / "b"))
    assert fault == "" and spark.read.parquet(path).count() > 0


def test_file_listing(spark, tmp_path):
    for name in ("a.h5", "b.txt", "2024/07/16/c.h5", "2024/07/d.h5"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(b"x" * 7)

    def names(layout, at=tmp_path):
        return sorted(os.path.basename(r.path) for r in catalog.file_catalog(spark, str(at), layout).collect())

    assert names("flat") == ["a.h5"]
    assert names("recursive") == ["a.h5", "c.h5", "d.h5"]
    assert names("dated") == ["a.h5"]
    os.remove(tmp_path / "a.h5")
    assert names("dated") == ["c.h5"]


def test_dictionaries_from_files(spark, tmp_path):
    (tmp_path / "b.json").write_text(
        '{"areas": {"A": {"beam_path": ["P", "Q"], "z_range": [1.5, 2.5], "sector": "S1", "devices": {}},'
        ' "B": {"sector": ["S1", "S2"]}}}'
    )
    (tmp_path / "d.json").write_text('{"KLYS": {"category": "rf", "controllable": true, "tags": ["t"]}}')
    dims = dictionaries.dim_tables(
        dictionaries.read_documents(spark, str(tmp_path / "b.json")), dictionaries.read_documents(spark, str(tmp_path / "d.json"))
    )
    assert {(r.area, r.z_min, r.z_max) for r in dims["area"].collect()} == {("A", 1.5, 2.5), ("B", None, None)}
    assert sorted(map(tuple, dims["area_sector"].collect())) == [("A", "S1"), ("B", "S1"), ("B", "S2")]
    assert dims["device"].first().tags == ["t"]


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "manifest")
    found = v.v_files(spark, SF).select("path", "ok")
    files.append_manifest(found, path)
    left = files.resume_filter(found, spark.read.parquet(path))
    assert left.count() == found.where("NOT ok").count()


def test_stream_repeats_leave_no_duplicates(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    v.v_requests(spark, SF).limit(200).repartition(4).write.parquet(source)
    providers = v.v_providers(spark, SF)
    for attempt in range(2):  # the second run has lost its progress and repeats every batch
        stream = streaming.request_stream(spark, source, 2)
        streaming.stream_ingest(stream, providers, out, str(tmp_path / f"c{attempt}"), True).awaitTermination()
    _, status = streaming.ingested(spark, out)
    assert status.count() == 200


def test_a_request_sent_twice_counts_once(spark, tmp_path):
    """The same requests in two files, read in two batches of one stream."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    requests = v.v_requests(spark, SF).where("provider_id LIKE 'prov-%'").limit(40)
    for mode in ("overwrite", "append"):
        requests.coalesce(1).write.mode(mode).parquet(source)
    stream = streaming.request_stream(spark, source, 1)
    streaming.stream_ingest(stream, v.v_providers(spark, SF), out, str(tmp_path / "c"), True).awaitTermination()
    found, status = streaming.ingested(spark, out)
    assert status.count() == 40 and found.count() == 2 * status.where("status = 'SUCCESS'").count()
    assert len(list((tmp_path / "out" / "buckets").rglob("*.parquet"))) == 2  # a file a task, whatever the days


def test_insert_reads_only_the_days_at_hand(spark, tmp_path, monkeypatch):
    for folder in ("day", "month"):
        path = str(tmp_path / folder)
        store.write_buckets(store_requests(spark, 400), path, folder=folder)
        plans = []
        real = store.save_buckets

        def seen(df, *args):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return real(df, *args)

        monkeypatch.setattr(store, "save_buckets", seen)
        more = store_requests(spark, 12, "new").unionByName(store_requests(spark, 10))
        assert store.write_buckets(more, path, folder=folder).count() == 412
        monkeypatch.undo()
        filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in plans[0].splitlines() if "PartitionFilters: [" in line]
        assert len(filters) == 1 and f"{folder}#" in filters[0] and any(f" {test} " in filters[0] for test in ("IN", "INSET", "="))
        day = spark.sql("SELECT date'1970-01-03' AS day").first().day
        assert store.of_days(store.read_buckets(spark, path), [day]).select("request_id").collect()[0][0] in ("r2", "new2")


def test_subscription_errors_reach_the_callback(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    v.v_requests(spark, SF).limit(5).write.parquet(source)

    def fail(batch, batch_id):
        raise ValueError("no")

    stream = streaming.request_stream(spark, source)
    streaming.stream_subscribe(stream, ["x"], 0, fail, str(tmp_path / "c"), seen.append, True).awaitTermination()
    assert [str(e) for e in seen] == ["no"]


def test_other_time_zone(spark):
    """Results do not depend on the zone of the session."""
    from chronolode.queries import all_queries

    names = ("parse_when", "ts_iso", "resolve_window", "file_timestamp", "time_range_hours", "query_buckets")
    queries = all_queries()
    before = {n: sorted(map(str, queries[n](spark, SF).collect())) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        for n in names:
            assert sorted(map(str, queries[n](spark, SF).collect())) == before[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scan_gets_the_filters(spark, tmp_path, capsys):
    """Signal, time and day tests reach the Parquet scan; unused columns are not read."""
    path = str(tmp_path / "s")
    store.save_buckets(buckets.pack_buckets(v.v_samples(spark, SF)), path)
    begin = 1_704_067_200 * S + 3 * schema.NS_PER_DAY
    found = buckets.query_samples(spark.read.parquet(path), begin, begin + S, ["BPMS_LI23_0_X"], max_span_days=1)
    capsys.readouterr()
    found.explain("formatted")
    plan = capsys.readouterr().out
    facts = {line.split(":")[0]: line for line in plan.splitlines() if ": [" in line or line.startswith("ReadSchema")}
    pushed = facts["PushedFilters"]
    assert "EqualTo(pv,BPMS_LI23_0_X)" in pushed
    assert f"GreaterThanOrEqual(last_ns,{begin})" in pushed and f"LessThan(first_ns,{begin + S})" in pushed
    assert "day" in facts["PartitionFilters"]
    assert "data_type" not in facts["ReadSchema"] and "sample_count" not in facts["ReadSchema"]


def store_requests(spark, n, prefix="r", declared=2):
    rows = [("prov", f"{prefix}{i}", [(f"PV_{i % 3}", [1.0 * i, 2.0])], 86_400 * S * i, declared) for i in range(n)]
    df = spark.createDataFrame(rows, "provider_id string, request_id string, columns array<struct<name:string,vals:array<double>>>, start bigint, n bigint")
    return df.selectExpr(
        "request_id", "provider_id", "'s' AS stream_id", "array('t') AS tags", "map('a', 'b') AS attributes",
        "named_struct('description', 'd', 'start_ns', start, 'stop_ns', start) AS event",
        "named_struct('kind', 'CLOCK', 'start_ns', start, 'period_ns', 5L, 'count', n, 'ts_ns', CAST(NULL AS ARRAY<BIGINT>)) AS ts",
        "columns", "start AS received_ns",
    )


def test_store_can_be_written_again(spark, tmp_path):
    path = str(tmp_path / "store")
    for _ in range(2):
        assert store.write_buckets(store_requests(spark, 30), path).count() == 30
    assert store.write_buckets(store_requests(spark, 40), path).count() == 40
    assert store.write_buckets(store_requests(spark, 5, "bad", declared=3), path).count() == 40  # inconsistent
    day = str(store.read_buckets(spark, path).agg({"day": "max"}).first()[0])
    for _ in range(2):
        store.compact_day(spark, path, str(tmp_path / "compact"), day)
    assert store.read_buckets(spark, str(tmp_path / "compact")).count() == 1


def test_streams_share_a_store(spark, tmp_path):
    """Two sources with checkpoints of their own keep all rows; merged twice, the batch store has each once."""
    out, batch = str(tmp_path / "out"), str(tmp_path / "batch")
    providers = spark.createDataFrame([("prov",)], "provider_id string")
    for name, n in (("a", 20), ("b", 30)):
        source = str(tmp_path / name)
        store_requests(spark, n, name).repartition(3).write.parquet(source)
        stream = streaming.request_stream(spark, source, 1, store_requests(spark, 1).schema)
        streaming.stream_ingest(stream, providers, out, str(tmp_path / f"progress-{name}"), True).awaitTermination()
    found, status = streaming.ingested(spark, out)
    assert status.count() == 50 and found.count() == 50
    plan = found.where(F.col("day") == F.lit("1970-01-03").cast("date"))._jdf.queryExecution().toString()
    # files are sorted by day, so the bounds of their row groups tell what to read
    assert "IsNotNull(day), EqualTo(day,1970-01-03)" in plan
    store.write_buckets(store_requests(spark, 10, "batch"), batch)
    for _ in range(2):
        streaming.merge_stream(spark, out, batch)
        assert store.read_buckets(spark, batch).count() == 60


def test_names_with_dots_and_two_values_at_an_instant(spark, tmp_path):
    nan = float("nan")
    rows = [("A.B", 1, 1.0), ("A.B", 2, nan), ("A.B", 2, 5.0), ("C`D", 1, 2.0), ("C`D", 2, nan)]
    df = spark.createDataFrame(rows, "pv string, ts_ns bigint, value double")
    table = tables.table_columns(df, None, None, ["A.B", "C`D"])
    back = {(r.pv, r.ts_ns): str(r.value) for r in tables.table_to_map(table).collect()}
    assert back == {("A.B", 1): "1.0", ("A.B", 2): "5.0", ("C`D", 1): "2.0", ("C`D", 2): "nan"}
    rows = {r.ts_ns: r["values"] for r in tables.table_rows(df, None, None).collect()}
    assert rows[2]["A.B"] == 5.0


def test_wide_export(spark, tmp_path):
    """More signals than one CSV table takes: several tables with one key."""
    pvs = [f"P.{i:04d}" for i in range(2500)]
    sets = spark.createDataFrame([(1, [(0, 10, pvs)])], "dataset_id int, blocks array<struct<begin_ns:bigint,end_ns:bigint,pvs:array<string>>>")
    samples = spark.createDataFrame([(p, i % 2, float(i)) for i, p in enumerate(pvs)], "pv string, ts_ns bigint, value double")
    path = export.export_csv(sets, samples, 1, str(tmp_path / "csv"))
    parts = sorted(os.listdir(path))
    assert parts == ["columns-00000", "columns-00001", "columns-00002"]
    read = [spark.read.option("header", True).csv(f"{path}/{p}") for p in parts]
    assert [c for df in read for c in df.columns if c != "ts_ns"] == pvs
    assert read[2].where("ts_ns = 1").first()["P.2499"] == "2499.0"


def test_annotation_ids_and_references(spark):
    rows = [("o", "n", [1], [], "x"), ("o", "n", [1], [], "y"), ("o", "n", [9], [], "x"), ("o", "n", [1], ["gone"], "x"), (None, "n", [9], [], "z")]
    incoming = spark.createDataFrame(rows, "owner string, name string, dataset_ids array<int>, annotation_ids array<string>, comment string")
    plain = annotations.create_annotations(incoming).collect()
    assert len({r.annotation_id for r in plain if r.annotation_id}) == 4
    known = spark.createDataFrame([(1,)], "dataset_id int"), spark.createDataFrame([("a",)], "annotation_id string")
    checked = [(r.message, r.annotation_id is None) for r in annotations.create_annotations(incoming, *known).collect()]
    assert sorted(checked) == sorted([("", False), ("", False), ("unknown dataset", True), ("unknown annotation", True), ("owner missing", True)])
    bad = spark.createDataFrame([("n", "o", "d", [(5, 4, ["p"])])], "name string, owner string, description string, blocks array<struct<begin_ns:bigint,end_ns:bigint,pvs:array<string>>>")
    assert datasets.create_datasets(bad).first().message == "incomplete data block"


def test_no_shuffle_by_signal_alone(spark):
    """Neither enrichment nor dataset joins deal rows out by the signal's name or the device type."""

    def exchanges(df):
        return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]

    enriched = spatial.spatial_enrich(v.v_samples(spark, SF), v.v_dims(spark, SF), "_")
    assert exchanges(enriched) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = datasets.dataset_buckets(v.v_datasets(spark, SF), v.v_buckets(spark, SF))
        assert not [x for x in exchanges(found) if "hashpartitioning(pv" in x and x.count("#") == 1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("folder", ["day", "month"])
def test_windows_prune_folders_on_both_sides(spark, tmp_path, folder):
    """Without being told how long buckets last; long buckets are found all the same."""
    path, day = str(tmp_path / "store"), 86_400 * S
    long = store_requests(spark, 1, "long").withColumn("ts", F.col("ts").withField("period_ns", F.lit(100 * day)))
    saved = store.write_buckets(store_requests(spark, 300).unionByName(long), path, folder=folder)
    begin, end = 90 * day, 92 * day
    found = buckets.query_buckets(store.read_buckets(spark, path), begin, end)
    assert sorted(r.request_id for r in found.collect()) == ["long0", "r90", "r91"]
    plain = buckets.query_buckets(saved.drop("span_days", "day", "month"), begin, end)
    assert sorted(r.request_id for r in plain.collect()) == ["long0", "r90", "r91"]
    plan = found._jdf.queryExecution().toString()
    scan = next(x for x in plan.split("\n") if "PartitionFilters" in x)
    filters = scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    assert f"{folder}#" in filters and "<= 1970-04-0" in filters and "(date_add(" in filters
