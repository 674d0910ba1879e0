"""Values of any type and conditions of samples through buckets and the store."""

import math

import pytest
from pyspark.sql import functions as F

from chronolode.operators import buckets, nested, stats, typed
from chronolode.sources.store import read_buckets, save_buckets, write_buckets

DAY = 86_400_000_000_000
# type, and values as SQL that makes a VARIANT
VALUES = {
    "DOUBLE": ["1.5D", "double('NaN')", "double('-Infinity')"],
    "LONG": ["9007199254740993L", "-9223372036854775808L", "0L"],
    "ULONG": ["18446744073709551615BD", "9223372036854775808BD", "7BD"],
    "BOOLEAN": ["true", "false", "true"],
    "STRING": ["''", "'é, \"x\"'", "'b'"],
    "BYTES": ["X'00FF'", "X''", "X'61'"],
    "TIMESTAMP": ["1L", "1700000000123456789L", "-5L"],
}


def given(spark, mixed=False, status=""):
    rows = []
    for kind, values in VALUES.items():
        cast = {"ULONG": "DECIMAL(20,0)"}.get(kind)
        for i, x in enumerate(values):
            value = f"CAST(CAST({x} AS {cast}) AS VARIANT)" if cast else f"CAST({x} AS VARIANT)"
            rows.append(f"SELECT '{'ANY' if mixed else kind}' AS pv, {i + (len(rows) if mixed else 0)}L AS ts_ns, '{kind}' AS data_type, {value} AS value{status}")
    nested = {"ARRAY": "parse_json('[1, [2, {\"a\": null}], \"x\"]')", "STRUCTURE": "parse_json('{\"b\": {\"c\": [1.5]}, \"a\": 9007199254740993}')"}
    nested["IMAGE"] = "to_variant_object(named_struct('file_type', 'PNG', 'image', X'0102'))"
    for kind, x in nested.items():
        rows.append(f"SELECT '{'ANY' if mixed else kind}', {100 + len(rows)}L, '{kind}', {x}{status}")
    return spark.sql(" UNION ALL ".join(rows))


def told(df):
    found = df.select("pv", "ts_ns", "data_type", F.schema_of_variant("value").alias("t"), F.to_json("value").alias("v")).collect()
    return sorted(tuple(r) for r in found)


@pytest.mark.parametrize("mixed", [False, True])
def test_every_type_comes_back_exactly(spark, tmp_path, mixed):
    samples = given(spark, mixed)
    made = typed.typed_buckets(samples)
    assert {r.data_type for r in made.collect()} == ({"MIXED"} if mixed else {*VALUES, "ARRAY", "STRUCTURE", "IMAGE"})
    save_buckets(made, str(tmp_path))
    stored = read_buckets(spark, str(tmp_path))
    # whole decimals are BIGINT where they fit, once they are read from JSON or from a decimal
    same = lambda rows: [(p, t, k, None if "DECIMAL" in s else s, v) for p, t, k, s, v in rows]
    assert same(told(typed.typed_samples(stored, "pv"))) == same(told(samples))


def test_natural_types(spark):
    v = "CAST({} AS VARIANT)"
    cases = {"2.5D": "DOUBLE", "3": "LONG", "'t'": "STRING", "true": "BOOLEAN", "X'01'": "BYTES", "TIMESTAMP'2024-01-01 00:00:00.5Z'": "TIMESTAMP", "2.5BD": "DOUBLE", "NULL": None}
    df = spark.sql("SELECT " + ", ".join(f"{v.format(x)} AS c{i}" for i, x in enumerate(cases)))
    got = df.select(*(typed.natural_type(F.col(f"c{i}")).alias(f"c{i}") for i in range(len(cases)))).first()
    assert [k if k != "LONG" else k for k in got] == [k if x != "3" else got[1] for x, k in cases.items()]
    instant = spark.sql("SELECT 'p' AS pv, 0L AS ts_ns, CAST(TIMESTAMP'2024-01-01 00:00:00.5Z' AS VARIANT) AS value")
    assert typed.typed_buckets(instant).first().longs == [1_704_067_200_500_000_000]


def test_values_that_do_not_fit_are_missing(spark):
    df = spark.sql("SELECT 'p' AS pv, id AS ts_ns, CASE id WHEN 0 THEN CAST(5L AS VARIANT) WHEN 1 THEN CAST('x' AS VARIANT) END AS value, 'LONG' AS data_type FROM range(3)")
    row = typed.typed_buckets(df).first()
    assert (row.data_type, row.longs, row.sample_count) == ("LONG", [5, None, None], 3)
    none = typed.typed_buckets(df.drop("data_type").where("ts_ns = 2")).first()
    assert (none.data_type, none.vals) == ("DOUBLE", [None])
    assert typed.typed_buckets(df.where("ts_ns > 5")).count() == 0


def test_labels_are_codes_or_texts(spark):
    few = spark.range(1000).selectExpr("'few' AS pv", "id AS ts_ns", "CAST('state ' || id % 3 AS VARIANT) AS value", "'ENUM' AS data_type")
    many = spark.range(1000).selectExpr("'many' AS pv", "id AS ts_ns", "CAST('text ' || id AS VARIANT) AS value", "'STRING' AS data_type")
    samples = few.union(many)
    made = typed.typed_buckets(samples)
    rows = {r.pv: r for r in made.collect()}
    assert rows["few"].labels == ["state 0", "state 1", "state 2"] and rows["few"].codes[:4] == [0, 1, 2, 0]
    assert rows["many"].codes is None and len(rows["many"].labels) == 1000
    assert told(typed.typed_samples(made, "pv")) == told(samples)


def test_hot_days_are_cut(spark):
    samples = spark.range(1000).selectExpr("'p' AS pv", "id AS ts_ns", "CAST(id AS VARIANT) AS value", "'LONG' AS data_type")
    made = typed.typed_buckets(samples, 300)
    assert sorted(r.sample_count for r in made.collect()) == [100, 300, 300, 300]
    assert told(typed.typed_samples(made, "pv")) == told(samples)


def conditions(spark):
    return spark.range(40).selectExpr(
        "'p' || id % 2 AS pv", "id AS ts_ns", "double(id) AS value",
        "CASE WHEN id % 2 = 0 AND id BETWEEN 10 AND 20 THEN 2 WHEN id > 30 THEN NULL ELSE 0 END AS severity",
        "CASE WHEN id % 2 = 0 AND id BETWEEN 16 AND 24 THEN 4 ELSE 0 END AS status",
        "CASE WHEN id % 2 = 0 AND id = 24 THEN 'why' WHEN id = 3 THEN '' END AS message",
    )


def test_conditions_are_runs(spark, tmp_path):
    made = buckets.pack_buckets(conditions(spark), status=True)
    runs = {r.pv: r.status_runs for r in made.collect()}
    assert runs["p1"] is None  # all normal
    assert [tuple(r) for r in runs["p0"]] == [(5, 0, 0, None), (3, 2, 0, None), (3, 2, 4, None), (1, 0, 4, None), (1, 0, 4, "why"), (7, 0, 0, None)]
    save_buckets(made, str(tmp_path))
    got = buckets.query_samples(read_buckets(spark, str(tmp_path)), 0, 1000)
    assert got.columns == ["pv", "bucket_id", "ts_ns", "value", "severity", "status", "message"]
    want = {r.ts_ns: (r.severity or 0, r.status, r.message or None) for r in conditions(spark).collect()}
    assert {r.ts_ns: (r.severity, r.status, r.message) for r in got.collect()} == want


def test_normal_conditions_take_no_room(spark, tmp_path):
    normal = conditions(spark).selectExpr("pv", "ts_ns", "value", "0 AS severity", "0 AS status", "string(NULL) AS message")
    row = buckets.pack_buckets(normal, status=True).first()
    assert row.status_runs is None

    def size(df, name):
        save_buckets(df, str(tmp_path / name))
        return sum(p.stat().st_size for p in (tmp_path / name).rglob("*.parquet"))

    many = spark.range(20_000).selectExpr("'p' || id % 7 AS pv", "id AS ts_ns", "rand(3) AS value", "0 AS severity", "0 AS status", "string(NULL) AS message")
    assert size(buckets.pack_buckets(many, status=True), "with") <= size(buckets.pack_buckets(many), "without") + 4_000


def test_store_of_requests(spark, tmp_path):
    value = "named_struct('value', CAST({} AS VARIANT), 'data_type', {}, 'severity', {}, 'status', 0, 'message', string(NULL))"
    column = lambda name, *values: f"named_struct('name', '{name}', 'values', array({', '.join(values)}))"
    columns = [
        column("state", value.format("'on'", "'ENUM'", 0), value.format("'off'", "'ENUM'", 2), value.format("'on'", "'ENUM'", 2)),
        column("count", value.format("9007199254740993L", "string(NULL)", 0), value.format("2L", "string(NULL)", 0), value.format("3L", "string(NULL)", 0)),
        column("short", value.format("1L", "string(NULL)", 0)),
    ]
    requests = spark.sql(
        f"""SELECT 'r' AS request_id, 'p' AS provider_id, 's' AS stream_id, array('t') AS tags, map('a', 'b') AS attributes,
        named_struct('description', 'd', 'start_ns', 0L, 'stop_ns', 1L) AS event, named_struct('kind', 'CLOCK', 'start_ns', 5L,
        'period_ns', 10L, 'count', 3L, 'ts_ns', CAST(NULL AS ARRAY<BIGINT>)) AS ts, array({', '.join(columns)}) AS columns, 9L AS received_ns"""
    )
    stored = write_buckets(requests, str(tmp_path))
    assert write_buckets(requests, str(tmp_path)).count() == 2  # the one of uneven length is left out, and nothing is stored twice
    rows = {(r.pv, r.ts_ns): (r.data_type, r.v, r.severity) for r in typed.typed_samples(stored, "pv").withColumn("v", F.to_json("value")).collect()}
    assert rows["state", 15] == ("ENUM", '"off"', 2) and rows["state", 5] == ("ENUM", '"on"', 0) and rows["count", 5] == ("LONG", "9007199254740993", 0)
    meta = {r.pv: r.last_data_type for r in stats.pv_metadata(stored).collect()}
    assert meta == {"state": "ENUM", "count": "LONG"}


def test_doubles_are_read_by_numeric_operators(spark):
    """A DOUBLE bucket of the typed form is one of the plain form."""
    samples = spark.range(50).selectExpr("'p' AS pv", "id AS ts_ns", "CASE WHEN id % 7 = 0 THEN double('NaN') ELSE double(id) END AS value")
    plain = buckets.query_samples(buckets.pack_buckets(samples), 0, 100)
    as_any = buckets.query_samples(typed.typed_buckets(samples.selectExpr("pv", "ts_ns", "CAST(value AS VARIANT) AS value")), 0, 100)
    key = lambda r: (r.ts_ns, "nan" if math.isnan(r.value) else r.value)
    assert sorted(map(key, plain.collect())) == sorted(map(key, as_any.collect()))


def test_nested_values_as_rows(spark):
    deep = "[" * 12 + "7" + "]" * 12
    df = spark.createDataFrame([(1, '[1,[2,{"a":null,"b":["x"]}],[],{}]'), (2, "5"), (3, None), (4, "null"), (5, deep), (6, '{"a.b":{"path":true}}')], "id int, t string")
    got = nested.array_rows(df.withColumn("v", F.try_parse_json("t")), "v", "id", "t").collect()
    rows = sorted((r.id, r.path, r.depth, r.kind, r.value.toPython()) for r in got)
    assert rows == [
        (1, "$[0]", 1, "numeric", 1),
        (1, "$[1][0]", 2, "numeric", 2),
        (1, "$[1][1].a", 3, "none", None),
        (1, "$[1][1].b[0]", 4, "string", "x"),
        (1, "$[2]", 1, "array", []),
        (1, "$[3]", 1, "structure", {}),
        (2, "$", 0, "numeric", 5),
        (4, "$", 0, "none", None),
        (5, "$" + "[0]" * 12, 12, "numeric", 7),
        (6, "$.a.b.path", 2, "bool", True),
    ]
    assert nested.array_rows(df.where("id = 3").withColumn("v", F.try_parse_json("t")), "v").count() == 0
