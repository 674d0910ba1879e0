"""Boundary rows with expected results written out."""

import math

import pytest
from pyspark.sql import functions as F

from chronolode.functions import archive, names, values
from chronolode.functions import timestamps as t
from chronolode.operators import axis, buckets, datasets, files, spatial, stats

NAN, INF = float("nan"), float("inf")
S = 1_000_000_000


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def samples(spark, series):
    rows = [(pv, i * S, v) for pv, vals in series.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "pv string, ts_ns bigint, value double")


@pytest.mark.parametrize("hot", [10**9, 0])
def test_statistics(spark, hot):
    df = samples(spark, {"a": [1.0, 3.0, 4.0, 10.0], "b": [NAN, NAN], "c": [1.0, INF], "d": [-2.0, 0.0, 5.0]})
    got = {r.pv: r for r in stats.pv_statistics(df, hot_samples=hot).collect()}
    a = got["a"]
    assert (a["count"], a.nan_count, a.mean, a.median, a.min, a.max) == (4, 0, 4.5, 3.5, 1.0, 10.0)
    assert a.std_dev == pytest.approx(math.sqrt(11.25))
    b = got["b"]
    assert (b["count"], b.nan_count, b.mean, b.median, b.std_dev, b.min, b.max) == (0, 2, None, None, None, None, None)
    assert got["c"].mean == INF and math.isnan(got["c"].std_dev) and got["c"].median == INF
    assert got["d"].median == 0.0
    zero = {r.pv: r for r in stats.pv_statistics(df, zero_fill=True, hot_samples=hot).collect()}
    assert (zero["b"].mean, zero["b"].median, zero["b"].max) == (0.0, 0.0, 0.0)


def test_strict_and_split_names(spark):
    p = F.lit("KLYS_LI23_31_PHAS_FASTBR")
    row = one(spark, names.parse_pv_strict(p)["attribute"], names.parse_pv_split(p)["measurement_type"])
    assert tuple(row) == ("PHAS_FASTBR", "PHAS")
    low = F.lit("klys_a_1_x")
    strict, split = one(spark, names.parse_pv_strict(low), names.parse_pv_split(low))
    assert (strict.device, strict.attribute, strict.units, split.valid) == ("unknown", "klys_a_1_x", "unknown", True)


def test_spatial_names(spark):
    bad, good = one(spark, names.parse_pv_spatial(F.lit("A:B:C:")), names.parse_pv_spatial(F.lit("A:B:C:D:E")))
    assert not bad.valid and good.valid and good.attribute == "D"


def test_colon_names(spark):
    two, none = one(spark, names.parse_pv_colon(F.lit("IOC:LI23:")), names.parse_pv_colon(F.lit("")))
    assert tuple(two) == ("IOC", "LI23", "UNKNOWN", "UNKNOWN")
    assert tuple(none) == ("UNKNOWN",) * 4


def test_file_names(spark):
    f, g, p = one(
        spark,
        names.parse_file_strict(F.lit("/d/CU_HXR_20250623_195500.h5")),
        names.parse_file_strict(F.lit("CU_HXR_2025_195500.h5")),
        names.parse_file_strict(F.lit("CU_HXR_20250623_195500_CoAD.h5")),
    )
    assert (f.project, f.file_ts, f.valid) == ("default", 1750708500, True)
    assert (g.origin, g.date, g.file_ts, g.valid) == ("unknown", "unknown", 0, False)
    assert p.project == "CoAD"
    month13 = names.parse_file_strict(F.lit("CU_HXR_20251323_195500.h5"))
    assert one(spark, month13["file_ts"], month13["valid"]) == (0, False)


def test_lenient_file_names(spark):
    a, b, c = one(spark, *[names.parse_file_lenient(F.lit(p)) for p in ("/x/A_B_20240101_1.h5", "/x/solo.h5", "A_.h5")])
    assert tuple(a) == ("A_B", "20240101", "1", "A_B_20240101_1.h5")
    assert tuple(b) == ("solo", "unknown_date", "unknown_time", "solo.h5")
    assert c.beam_line == "A"


@pytest.mark.parametrize(
    ("attribute", "units", "kind"),
    [("X", "mm", "position"), ("BACT", "kG", "actual"), ("PHAS_AMPL", "deg", "phase"), ("FOO", "unknown", "measurement"),
     ("WGTEMP", "°C", "temperature"), ("XVOLT", "V", "voltage")],
)
def test_units(spark, attribute, units, kind):
    assert one(spark, names.infer_units(F.lit(attribute)), names.infer_signal_type(F.lit(attribute))) == (units, kind)


def test_spatial_position(spark):
    area = spark.createDataFrame([("LI", 100.0, 200.0, ["P"], "d")], "area string, z_min double, z_max double, beam_path array<string>, description string")
    pvs = spark.createDataFrame([("LI", p) for p in ("61", "A7", "61abc")] + [("NO", "61")], "area string, position string")
    got = {(r.area, r.position): (r.z, r.z_unc) for r in spatial.spatial_position(pvs, area).collect()}
    assert got[("LI", "61")] == (pytest.approx(106.1), 0.1)
    assert got[("LI", "A7")] == (150.0, 50.0)
    assert got[("LI", "61abc")] == (pytest.approx(106.1), 0.1)
    assert got[("NO", "61")] == (0.0, 1.0)


def longs(*xs):
    return F.array(*[F.lit(x).cast("bigint") for x in xs])


def test_periods(spark):
    row = one(
        spark,
        t.period_first_pair(longs(5)),
        t.period_whole_sec(longs(7, 7), guard=False),
        t.period_whole_sec(longs(7, 7)),
        t.guard_period(F.lit(99)),
        t.guard_period(F.lit(100)),
        t.guard_period(F.lit(10_000_000_001)),
    )
    assert tuple(row) == (S, 0, S, S, 100, S)


@pytest.mark.parametrize(
    ("instants", "expected"),
    [
        ([0, 10_000, 21_000], True),
        ([0, 10_000, 21_001], False),
        ([0, 9], True),
        ([i * 10_000 for i in range(11)] + [10**9], True),
        ([i * 10_000 for i in range(10)] + [10**9], False),
    ],
)
def test_regular_sampling(spark, instants, expected):
    df = spark.createDataFrame([("p", i, 0.0) for i in instants], "pv string, ts_ns bigint, value double")
    assert axis.regular_sampling(df).first().regular is expected
    ts = longs(*instants)
    assert one(spark, t.regular_gaps(ts, t.period_first_pair(ts)))[0] is expected


@pytest.mark.parametrize(
    ("dims", "count", "expected"),
    [((8,), 8, 0), ((3, 8), 8, 1), ((1000, 3), 995, 0), ((1, 50), 8, 1), ((50, 1), 8, 0), ((1, 1), 8, 1), ((4, 9, 9), 100, 1),
     ((7,), 100, 0), ((2, 2, 2, 2), 2, None)],
)
def test_time_axis(spark, dims, count, expected):
    assert one(spark, t.time_axis(longs(*dims), F.lit(count).cast("bigint")))[0] == expected


def test_axis_slice(spark):
    vals = F.array(*[F.lit(float(i)) for i in range(24)])
    dims = longs(2, 3, 4)
    got = one(spark, *[t.axis_slice(vals, dims, F.lit(k)) for k in range(3)])
    assert list(got) == [[0.0, 12.0], [0.0, 4.0, 8.0], [0.0, 1.0, 2.0, 3.0]]


def test_archive_quality(spark):
    def rows(pv, valid, invalid, severity=0):
        return [(pv, 1.0, severity)] * valid + [(pv, NAN, severity)] * invalid

    df = spark.createDataFrame(
        rows("p90", 9, 1) + rows("p91", 91, 9) + rows("p10", 1, 9) + rows("p9", 9, 91) + [("sev3", 1.0, 3), ("sev1", 1.0, 1)],
        "pv string, value double, severity int",
    )
    got = {r.pv: r for r in stats.archive_quality(df).collect()}
    assert got["p90"].tags == [] and got["p91"].tags == ["high_quality_data"]
    assert got["p10"].tags == [] and got["p9"].tags == ["low_quality_data"]
    assert (got["sev3"].valid_count, got["sev3"].alarm_count) == (0, 1)
    assert (got["sev1"].valid_count, got["sev1"].alarm_count) == (1, 1)


def test_alarm_names(spark):
    row = one(spark, archive.severity_name(F.lit(3)), archive.severity_name(F.lit(4)), archive.status_name(F.lit(21)), archive.status_name(F.lit(-1)))
    assert tuple(row) == ("INVALID", "UNKNOWN", "WRITE_ACCESS", "UNKNOWN")


def test_difference_ms(spark):
    a, b = one(
        spark,
        t.ts_diff_ms(F.lit(1_500_000).cast("bigint"), F.lit(0).cast("bigint")),
        t.ts_diff_ms(F.lit(0).cast("bigint"), F.lit(S + 999_999).cast("bigint")),
    )
    assert (a, b) == (-1, 1000)


def test_windows(spark):
    none = F.lit(None).cast("string")
    d, h = F.lit("01152024"), F.lit("143000")
    begin = 1_705_329_000
    q, ds, wide, bad = one(
        spark,
        t.resolve_window(d, h, none, F.lit("235959"), "query"),
        t.resolve_window(d, h, none, none, "dataset"),
        t.resolve_window(none, none, none, none, "dataset"),
        t.resolve_window(F.lit("13402024"), h, none, none, "query"),
    )
    assert tuple(q) == (begin * S, (begin + 3600) * S)
    assert tuple(ds) == (begin * S, (begin + 86_400) * S)
    assert tuple(wide) == (S, 2_147_483_647 * S)
    assert tuple(bad) == (None, None)


def test_worked_example(spark):
    """The documented bucket: id, and the last of 453,456 samples to the millisecond."""
    first = 1_752_695_016_338_222_271
    last = first + 453_455 * 8_257_539
    row = one(
        spark,
        buckets.bucket_id(F.lit("KLYS_LI20_61_AMPL"), F.lit(first)),
        t.ts_iso(F.lit(last).cast("bigint"), 3),
        t.clock_duration_ns(F.lit(8_257_539), F.lit(0)),
        t.clock_frequency_hz(F.lit(0)),
    )
    assert tuple(row) == ("KLYS_LI20_61_AMPL-1752695016-338222271", "2025-07-16T20:46:00.760Z", None, 0.0)


def test_slices(spark):
    a = F.array(F.lit(1.0))
    assert list(one(spark, values.array_slice(a, 0, 2), values.array_slice(a, 1, 5), values.array_slice(a, 4, 2))) == [[1.0], [], []]
    assert one(spark, values.array_get(a, 1))[0] is None


def test_admission_bounds(spark):
    sizes = [1023, 1024, 10 * 1024**3, 10 * 1024**3 + 1]
    df = spark.createDataFrame([(str(n), n) for n in sizes], "path string, file_bytes bigint")
    assert {r.file_bytes for r in files.file_admission(df, files.MIN_FILE_BYTES, files.MAX_FILE_BYTES).where("admitted").collect()} == set(sizes[1:3])


def test_dataset_criteria(spark):
    block = [(0, 10, ["p"])]
    df = spark.createDataFrame(
        [(1, "alpha", "A", "x", block), (2, "beta", "A", "y", []), (3, "gamma", "B", "alpha", block)],
        "dataset_id int, name string, owner string, description string, blocks array<struct<begin_ns:bigint,end_ns:bigint,pvs:array<string>>>",
    )

    def ids(**criteria):
        return sorted(r.dataset_id for r in datasets.datasets_query(df, **criteria).collect())

    assert ids(owner="A", text="BETA", pv="p") == [1, 2]
    assert ids(text="alpha") == [1, 3]
    assert ids(owner="B", pv="p") == [3]
    assert ids() == [1, 2, 3]
    extent = {r.dataset_id: (r.begin_ns, r.end_ns) for r in datasets.dataset_extent(df).collect()}
    assert extent == {1: (0, 10), 2: (None, None), 3: (0, 10)}


def test_moving_average(spark):
    log = spark.createDataFrame([("r", 1, 10.0), ("r", 2, 20.0), ("r", 3, 400.0)], "run string, done int, seconds double")
    assert stats.ingest_ema(log, "run", ["done"]).first().ema == pytest.approx(32.61)


def test_attributes(spark):
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("a", "1"), ("b", "2"), ("a", "3"))])
    row = one(
        spark,
        values.attr_to_map(pairs)["a"],
        values.attr_find(pairs, "a"),
        F.transform(values.attr_upsert(pairs, "a", "9"), lambda p: p["value"]),
        F.size(values.attr_upsert(pairs, "z", "0")),
    )
    assert tuple(row) == ("3", "1", ["9", "2", "3"], 4)


def test_text_words(spark):
    row = one(
        spark,
        values.text_match("Night-shift", F.lit("the SHIFT began")),
        values.text_match("hift", F.lit("the SHIFT began")),
        values.text_match("a.b", F.lit("axb")),
        values.text_match("?!", F.lit("anything")),
        values.text_match("x", F.lit(None).cast("string")),
    )
    assert tuple(row) == (True, False, False, False, False)


def test_values(spark):
    def v(text):
        return F.try_parse_json(F.lit(text))

    kinds = one(spark, *[values.value_kind(v(x)) for x in ("1", "1.5", "1e300", '"s"', "true", "[1]", "{}", "null")])
    assert list(kinds) == ["numeric"] * 3 + ["string", "bool", "array", "structure", "none"]
    row = one(spark, values.value_as_double(v('"1"')), values.value_as_double(v('"1"'), "null"), values.value_as_double(v("2")))
    assert math.isnan(row[0]) and row[1] is None and row[2] == 2.0
