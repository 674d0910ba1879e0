"""Input views over the given tables, once as DataFrames and once as SQL.

Scalar expressions are written once and serve both engines; ``US(x)`` stands
for microseconds since the epoch. Packed arrays are built inside their row, and
the SQL side keeps them in long form.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolode.operators.buckets import pack_buckets, request_buckets
from chronolode.operators.typed import typed_buckets
from chronolode.schema import CLOCK


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _spark(expr: str) -> str:
    return re.sub(r"US\((\w+)\)", r"unix_micros(from_utc_timestamp(CAST(\1 AS TIMESTAMP), current_timezone()))", expr)


def _duck(expr: str) -> str:
    return re.sub(r"US\((\w+)\)", r"epoch_us(\1)", expr)


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{_spark(e)} AS {n}" for n, e in columns.items()])


def _sql(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ", ".join(f"{_duck(e)} AS {n}" for n, e in columns.items()) + f" FROM {source}"


SAMPLES = {
    "event_id": "event_id",
    "user_id": "user_id",
    "pv": """CASE event_type WHEN 'view' THEN 'BPMS' WHEN 'click' THEN 'KLYS' WHEN 'purchase' THEN 'QUAD'
        WHEN 'signup' THEN 'BEND' ELSE 'TMIT' END
        || '_' || CASE user_id % 6 WHEN 0 THEN 'LI23' WHEN 1 THEN 'DMPH' WHEN 2 THEN 'LTUH'
                                   WHEN 3 THEN 'BSY' WHEN 4 THEN 'LI20' ELSE 'UNDS' END
        || '_' || CASE WHEN user_id % 25 = 7 THEN 'A' || CAST(user_id AS STRING) ELSE CAST(user_id AS STRING) END
        || '_' || CASE event_type WHEN 'view' THEN 'X' WHEN 'click' THEN 'PHAS_FASTBR' WHEN 'purchase' THEN 'BCTRL'
                                  WHEN 'signup' THEN 'AMPL' ELSE 'TMITBR' END""",
    "ts_ns": "US(ts) * 1000",
    "value": """CASE WHEN event_id % 17 = 0 THEN CAST('NaN' AS DOUBLE)
        WHEN event_id % 53 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE value END""",
    "severity": "CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 4 AS INT) ELSE 0 END",
    "status": "CASE WHEN event_id % 15 = 0 THEN CAST(event_id % 8 AS INT) ELSE 0 END",
    "message": "CASE WHEN event_id % 15 = 0 AND event_id % 8 > 5 THEN 'alarm ' || CAST(event_id % 8 AS STRING) END",
}

# a sample's type goes by its signal; signals of odd users among the last kind have values of two types
TYPED = SAMPLES | {
    "kind": """CASE event_type WHEN 'view' THEN 'DOUBLE' WHEN 'click' THEN 'LONG' WHEN 'purchase' THEN 'ENUM'
        WHEN 'signup' THEN 'BOOLEAN' ELSE CASE WHEN user_id % 2 = 0 THEN 'STRUCTURE'
            WHEN event_id % 2 = 0 THEN 'ULONG' ELSE 'STRING' END END""",
    "whole": "CAST(9007199254740993 + event_id AS BIGINT)",
    "beyond": "CAST('18446744073709000000' AS DECIMAL(20,0)) + CAST(event_id AS DECIMAL(20,0))",
    "state": "CASE event_id % 3 WHEN 0 THEN 'off' WHEN 1 THEN 'on' ELSE 'fault' END",
    "flag": "event_id % 2 = 0",
    "props": "props",
}

POINTS = {
    "event_id": "event_id",
    "name": "event_type",
    "ts_ns": "US(ts) * 1000",
    "value": "CASE WHEN event_id % 17 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END",
    "severity": "CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 4 AS INT) ELSE 0 END",
    "status": "CAST(event_id % 24 AS INT)",
}

FILES = {
    "file_no": "o_orderkey",
    "path": """'/data/' || CASE WHEN o_orderkey % 10 = 9 THEN 'raw-dump ' || CAST(o_orderkey AS STRING)
        ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'CU' ELSE 'SC' END || '_'
          || CASE WHEN o_orderkey % 3 = 0 THEN 'HXR' ELSE 'SXR' END || '_'
          || replace(substr(CAST(o_orderdate AS STRING), 1, 10), '-', '') || '_'
          || lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')
          || lpad(CAST(o_orderkey * 7 % 60 AS STRING), 2, '0')
          || CASE WHEN o_orderkey % 4 = 1 THEN '_P' || CAST(o_custkey % 9 AS STRING) ELSE '' END END || '.h5'""",
    "file_bytes": """CASE WHEN o_orderkey % 50 = 0 THEN CAST(512 AS BIGINT)
        WHEN o_orderkey % 51 = 0 THEN CAST(11811160064 AS BIGINT)
        ELSE CAST(floor(o_totalprice) AS BIGINT) * 64 END""",
    "processed": "o_orderkey % 4 = 0",
    "ok": "o_orderstatus <> 'P'",
    "seconds": "o_totalprice / 1000",
    "done_us": "US(o_orderdate)",
}

# one decoded signal per line item; its file is the order
RAW = {
    "file_no": "l_orderkey",
    "path": """'/data/' || CASE WHEN l_orderkey % 2 = 0 THEN 'CU' ELSE 'SC' END || '_'
        || CASE WHEN l_orderkey % 3 = 0 THEN 'HXR' ELSE 'SXR' END || '_202401'
        || lpad(CAST(1 + l_orderkey % 31 AS STRING), 2, '0') || '_'
        || lpad(CAST(l_orderkey % 1000000 AS STRING), 6, '0')
        || CASE WHEN l_orderkey % 4 = 1 THEN '_P' || CAST(l_orderkey % 9 AS STRING) ELSE '' END || '.h5'""",
    "n_objects": "CAST(CASE WHEN l_orderkey % 97 = 0 THEN 10001 ELSE 9 END AS INT)",
    "signal_name": """CASE l_linenumber % 4 WHEN 0 THEN 'secondsPastEpoch' ELSE
        CASE l_linenumber % 3 WHEN 0 THEN 'KLYS' WHEN 1 THEN 'BPMS' ELSE 'QUAD' END
        || '_LI23_' || CAST(l_partkey % 90 AS STRING) || '_'
        || CASE l_linenumber % 2 WHEN 0 THEN 'AMPL' ELSE 'X' END || CAST(l_linenumber AS STRING) END""",
    "price": "l_extendedprice",
    "quantity": "l_quantity",
}

REQUESTS = {
    "request_id": "'req-' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "provider_id": """CASE WHEN l_orderkey % 29 = 0 THEN '' WHEN l_partkey % 10 = 3 THEN 'gone-' || CAST(l_suppkey AS STRING)
        ELSE 'prov-' || CAST(l_suppkey AS STRING) END""",
    "stream_id": "'stream-' || CAST(l_orderkey % 40 AS STRING)",
    "suffix": "CAST(l_partkey AS STRING) || '_' || CAST(l_linenumber AS STRING)",
    "declared": "CAST(CASE WHEN l_orderkey % 13 = 0 THEN 5 ELSE 4 END AS BIGINT)",
    "start_ns": "US(l_shipdate) * 1000 + l_orderkey",
    "period_ns": "CAST(8257539 AS BIGINT)",
    "price": "l_extendedprice",
    "quantity": "l_quantity",
}

PROVIDERS = {
    "provider_id": "'prov-' || CAST(s_suppkey AS STRING)",
    "name": "s_name",
    "description": "'provider in nation ' || n_name",
    "tag1": "n_name",
    "tag2": "CASE WHEN s_acctbal < 0 THEN 'debit' ELSE 'credit' END",
    "attr_name": "'nation'",
    "attr_value": "n_name",
}

STATUS = {
    "status_id": "'st-' || CAST(o_orderkey AS STRING)",
    "provider_id": "'prov-' || CAST(o_custkey % 120 AS STRING)",
    "request_id": "'req-' || CAST(o_orderkey AS STRING)",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'REJECTED' ELSE 'ERROR' END",
    "message": "o_orderpriority",
    "update_ns": "US(o_orderdate) * 1000",
}

DATASETS = {
    "dataset_id": "c_custkey",
    "name": "c_name",
    "owner": "'nation-' || CAST(c_nationkey AS STRING)",
    "description": "'study of ' || c_mktsegment",
    "user_id": "c_custkey % 150",
}
_BEGIN = "1704067200000000000 + ((c_custkey * ({k} * 6 + 1)) % 28) * 86400000000000"
_END = "1704067200000000000 + ((c_custkey * ({k} * 6 + 1)) % 28 + 2 - {k}) * 86400000000000"

ANNOTATIONS = {
    "annotation_id": "doc_id",
    "owner": "source",
    "name": "'note ' || CAST(doc_id AS STRING)",
    "comment": "text",
    "tag": "lang",
    "attr_name": "'n_chars'",
    "attr_value": "CAST(n_chars AS STRING)",
    "dataset_id": "doc_id % 200",
    "linked_id": "CASE WHEN doc_id > 0 THEN CAST(floor(doc_id / 2) AS BIGINT) END",
    "event_description": "'run of ' || source",
}

ARCHIVE = {
    "pv": "'IOC:LI23:' || CAST(user_id AS STRING) || ':TEMP'",
    "user_id": "user_id",
    "payload": """'[{"meta":{"name":"IOC:LI23:' || CAST(user_id AS STRING) || ':TEMP","EGU":"C","DESC":"probe"'
        || CASE WHEN user_id % 3 = 0 THEN ',"ENUM_0":"off","ENUM_1":"on"' ELSE '' END || '},"data":['
        || CASE WHEN user_id % 7 = 0 THEN '' ELSE '{"secs":1700000000,"nanos":5,"val":' || CAST(user_id AS STRING)
        || ',"severity":0,"status":0},{"secs":1700000060,"nanos":5,"val":"bad","severity":1,"status":3},'
        || '{"secs":1700000121,"nanos":5,"val":7.5,"severity":3,"status":17}' END || ']}]'""",
}

VALUES = {
    "event_id": "event_id",
    "props": "props",
    "value_json": """CASE event_id % 4 WHEN 0 THEN CAST(value AS STRING) WHEN 1 THEN 'true'
        WHEN 2 THEN '"txt"' ELSE props END""",
    "file_type": """CASE event_id % 9 WHEN 0 THEN 'RAW' WHEN 1 THEN 'JPEG' WHEN 2 THEN 'GIF' WHEN 3 THEN 'TIFF'
        WHEN 4 THEN 'BMP' WHEN 5 THEN 'PNG' WHEN 6 THEN 'EPS' WHEN 7 THEN 'SVG' ELSE 'PDF' END""",
}

NESTED = {
    "event_id": "event_id",
    "event_type": "event_type",
    "props": "props",
    "nested_json": """CASE event_id % 4 WHEN 0 THEN '[1,[' || CAST(event_id AS STRING) || ',' || props || '],[]]'
        WHEN 1 THEN '{"a":{"b":[true,null]},"t":"' || event_type || '"}' WHEN 2 THEN props END""",
}

EVENTS_META = {
    "id": "o_orderkey",
    "start_ns": "US(o_orderdate) * 1000",
    "stop_ns": "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE (US(o_orderdate) + o_orderkey * 1000) * 1000 END",
}

AREA_ROWS = """(VALUES ('LI23', 100.0, 200.0, 'P1'), ('DMPH', 900.0, 950.0, 'P2'), ('LTUH', 700.0, 880.0, 'P2'),
    ('BSY', 500.0, 640.0, 'P1'), ('UNDS', 300.0, 360.0, 'P3'))"""
DEVICE_ROWS = """(VALUES ('BPMS', 'diagnostic', true), ('KLYS', 'rf', true), ('QUAD', 'magnet', true))"""


# --- DataFrames ------------------------------------------------------------


def v_samples(spark, sf):
    return _select(table(spark, sf, "events"), SAMPLES)


def v_typed(spark, sf):
    """Samples whose ``value`` is a VARIANT of the type in ``data_type``."""
    rows = _select(table(spark, sf, "events"), TYPED)
    value = """CASE kind WHEN 'DOUBLE' THEN CAST(value AS VARIANT) WHEN 'LONG' THEN CAST(whole AS VARIANT)
        WHEN 'BOOLEAN' THEN CAST(flag AS VARIANT) WHEN 'STRUCTURE' THEN parse_json(props)
        WHEN 'ULONG' THEN CAST(CAST(beyond AS DECIMAL(20,0)) AS VARIANT) ELSE CAST(state AS VARIANT) END"""
    return rows.selectExpr("pv", "ts_ns", "kind AS data_type", f"{value} AS value", "severity", "status", "message")


def v_points(spark, sf):
    return _select(table(spark, sf, "events"), POINTS)


def v_files(spark, sf):
    return _select(table(spark, sf, "orders"), FILES)


_STEPS = "sequence(0L, 7L)"
_RAW_ARRAYS = {
    "secs": f"transform({_STEPS}, i -> 1700000000 + file_no * 10 + i div 4)",
    "nanos": f"""CASE WHEN file_no % 7 = 0 THEN NULL WHEN file_no % 23 = 0 THEN sequence(0L, 6L)
        ELSE transform({_STEPS}, i -> i % 4 * 250000000
            + CASE WHEN file_no % 5 = 0 AND i = 3 THEN 5000 ELSE 0 END) END""",
    "texts": f"""transform({_STEPS}, i -> CASE WHEN file_no % 11 = 0 AND i = 2 THEN 'n/a'
        ELSE CAST(quantity + i AS STRING) END)""",
    "dims": """CASE file_no % 5 WHEN 0 THEN array(8L) WHEN 1 THEN array(8L, 1L) WHEN 2 THEN array(1L, 8L)
        WHEN 3 THEN array(2L, 8L) ELSE array(3L, 2L, 8L) END""",
    "vals": """transform(sequence(0L, CASE file_no % 5 WHEN 3 THEN 15L WHEN 4 THEN 47L ELSE 7L END),
        j -> quantity + j % 8 + 100 * (j div 8))""",
}


def v_raw(spark, sf, *arrays):
    """Decoded signals: eight samples each, with odd axes and texts mixed in.

    ``inline`` makes the arrays asked for real columns, as a file reader would,
    so that no expression over them repeats their making.
    """
    rows = _select(table(spark, sf, "lineitem"), RAW)
    plain = ["file_no", "path", "n_objects", "10L * 1024 * (1 + file_no % 7) AS file_bytes", "signal_name", "price"]
    if not arrays:
        return rows.selectExpr(*plain)
    fields = ", ".join(f"'{name}', {_RAW_ARRAYS[name]}" for name in arrays)
    return rows.selectExpr(*plain, f"inline(array(named_struct({fields})))")


def v_requests(spark, sf):
    """Ingest requests: one per line item with two columns of four values, built inside the row."""
    steps = "sequence(0, 3)"
    rows = _select(table(spark, sf, "lineitem"), REQUESTS)
    return rows.selectExpr(
        "request_id",
        "provider_id",
        "stream_id",
        "array('order') AS tags",
        "map('stream', stream_id) AS attributes",
        """named_struct('description', 'run ' || stream_id, 'start_ns', start_ns,
            'stop_ns', start_ns + 3 * period_ns) AS event""",
        f"""named_struct('kind', '{CLOCK}', 'start_ns', start_ns, 'period_ns', period_ns, 'count', declared,
            'ts_ns', CAST(NULL AS ARRAY<BIGINT>)) AS ts""",
        f"""array(named_struct('name', 'PV_' || suffix, 'vals', transform({steps}, i -> price + i)),
            named_struct('name', 'QT_' || suffix, 'vals', transform({steps}, i -> quantity + i))) AS columns""",
        "start_ns AS received_ns",
    )


def v_providers(spark, sf):
    joined = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey")
    )
    return _select(joined, PROVIDERS).select(
        "provider_id",
        "name",
        "description",
        F.array("tag1", "tag2").alias("tags"),
        F.create_map("attr_name", "attr_value").alias("attributes"),
    )


def v_status(spark, sf):
    return _select(table(spark, sf, "orders"), STATUS)


def v_datasets(spark, sf):
    """Datasets of two blocks; a block's signals are all those of one user."""
    pvs = v_samples(spark, sf).select("user_id", "pv").distinct()
    lists = pvs.groupBy("user_id").agg(F.array_sort(F.collect_list("pv")).alias("pvs"))
    blocks = [
        f"named_struct('begin_ns', {_BEGIN.format(k=k)}, 'end_ns', {_END.format(k=k)}, 'pvs', pvs)" for k in (0, 1)
    ]
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey", *[f"{e} AS {n}" for n, e in DATASETS.items()]
    )
    return rows.join(lists, "user_id", "left").selectExpr(
        "dataset_id", "name", "owner", "description", f"array({', '.join(blocks)}) AS blocks"
    )


def v_annotations(spark, sf):
    return _select(table(spark, sf, "documents"), ANNOTATIONS).selectExpr(
        "annotation_id",
        "owner",
        "name",
        "comment",
        "array(tag) AS tags",
        "map(attr_name, attr_value) AS attributes",
        "array(dataset_id) AS dataset_ids",
        "array_compact(array(linked_id)) AS annotation_ids",
        "event_description",
    )


def v_archive_json(spark, sf):
    return _select(table(spark, sf, "events").select("user_id").distinct(), ARCHIVE)


def v_values(spark, sf):
    return _select(table(spark, sf, "events"), VALUES)


def v_nested(spark, sf):
    return _select(table(spark, sf, "events"), NESTED)


def v_events_meta(spark, sf):
    return _select(table(spark, sf, "orders"), EVENTS_META)


def v_dims(spark, sf):
    area = spark.sql(
        f"""SELECT area, CAST(z_min AS DOUBLE) AS z_min, CAST(z_max AS DOUBLE) AS z_max, array(beam_path) AS beam_path,
        'area ' || area AS description FROM {AREA_ROWS} AS a(area, z_min, z_max, beam_path)"""
    )
    device = spark.sql(
        f"""SELECT device_type, category, 'does ' || category AS function, controllable, array('kind_' || category)
        AS tags FROM {DEVICE_ROWS} AS d(device_type, category, controllable)"""
    )
    return {"area": area, "device": device}


def v_buckets(spark, sf, status=False):
    return pack_buckets(v_samples(spark, sf), status=status)


def v_typed_buckets(spark, sf):
    return typed_buckets(v_typed(spark, sf))


def v_clock_buckets(spark, sf):
    return request_buckets(v_requests(spark, sf))


# --- SQL twins -------------------------------------------------------------

_BLOCK_SQL = " UNION ALL ".join(
    "SELECT c_custkey AS dataset_id, {k} AS block_no, {b} AS begin_ns, {e} AS end_ns, c_custkey % 150 AS user_id "
    "FROM customer".format(k=k, b=_BEGIN.format(k=k), e=_END.format(k=k))
    for k in (0, 1)
)

SQL = {
    "v_samples": _sql(SAMPLES, "events"),
    "v_points": _sql(POINTS, "events"),
    "v_typed": _sql(TYPED, "events").replace("AS STRING", "AS VARCHAR"),
    "v_typed_buckets": """SELECT pv || '-' || CAST(min(ts_ns) // 1000000000 AS VARCHAR) || '-'
            || CAST(min(ts_ns) % 1000000000 AS VARCHAR) AS bucket_id, pv, min(ts_ns) AS first_ns, max(ts_ns) AS last_ns,
        count(*) AS sample_count, CASE WHEN count(DISTINCT kind) > 1 THEN 'MIXED' ELSE min(kind) END AS data_type,
        CASE WHEN count(DISTINCT kind) > 1 THEN count(DISTINCT kind) WHEN min(kind) IN ('ENUM', 'STRING') THEN count(DISTINCT state) END
            AS n_labels,
        CASE WHEN min(kind) = 'LONG' THEN CAST(sum(whole) AS VARCHAR) END AS whole_sum,
        CASE WHEN min(kind) = 'BOOLEAN' THEN count_if(flag) END AS n_true,
        count_if(severity <> 0 OR status <> 0 OR message IS NOT NULL) AS n_odd
        FROM v_typed GROUP BY pv, ts_ns // 86400000000000""",
    "v_files": _sql(FILES, "orders"),
    # lid tells equal line items apart
    "v_raw": f"SELECT row_number() OVER () AS lid, * FROM ({_sql(RAW, 'lineitem')})",
    "v_raw_long": """SELECT v_raw.*, t.i AS i,
        1700000000 + file_no * 10 + CAST(floor(t.i / 4) AS BIGINT) AS sec,
        CASE WHEN file_no % 7 = 0 THEN 0 ELSE CAST(t.i % 4 AS BIGINT) * 250000000
            + CASE WHEN file_no % 5 = 0 AND t.i = 3 THEN 5000 ELSE 0 END END AS nano,
        CASE WHEN file_no % 11 = 0 AND t.i = 2 THEN 'n/a' ELSE CAST(quantity + t.i AS VARCHAR) END AS val_text
        FROM v_raw CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5),(6),(7)) AS t(i)""",
    "v_requests": f"SELECT row_number() OVER () AS lid, 2 AS n_columns, * FROM ({_sql(REQUESTS, 'lineitem')})",
    "v_requests_long": """SELECT r.*, c.prefix || suffix AS pv, t.i AS i,
        CASE c.prefix WHEN 'PV_' THEN price + t.i ELSE quantity + t.i END AS value
        FROM v_requests r CROSS JOIN (VALUES ('PV_'), ('QT_')) AS c(prefix)
        CROSS JOIN (VALUES (0),(1),(2),(3)) AS t(i)""",
    "v_clock_buckets": """SELECT pv || '-' || CAST(start_ns // 1000000000 AS VARCHAR) || '-'
            || CAST(start_ns % 1000000000 AS VARCHAR) AS bucket_id, lid, pv, provider_id, request_id,
        start_ns AS first_ns, start_ns + period_ns * (declared - 1) AS last_ns, declared AS sample_count,
        period_ns, sum(value) AS value_sum
        FROM v_requests_long GROUP BY lid, pv, provider_id, request_id, start_ns, period_ns, declared""",
    "v_providers": _sql(PROVIDERS, "supplier JOIN nation ON n_nationkey = s_nationkey"),
    "v_status": _sql(STATUS, "orders"),
    "v_datasets": _sql(DATASETS, "customer"),
    "v_dataset_blocks": _BLOCK_SQL,
    "v_user_pvs": "SELECT DISTINCT user_id, pv FROM v_samples",
    "v_annotations": _sql(ANNOTATIONS, "documents"),
    "v_archive_json": _sql(ARCHIVE, "(SELECT DISTINCT user_id FROM events)"),
    "v_values": _sql(VALUES, "events"),
    "v_nested": _sql(NESTED, "events"),
    "v_events_meta": _sql(EVENTS_META, "orders"),
    "v_dim_area": f"""SELECT area, CAST(z_min AS DOUBLE) AS z_min, CAST(z_max AS DOUBLE) AS z_max, beam_path
        FROM {AREA_ROWS} AS a(area, z_min, z_max, beam_path)""",
    "v_dim_device": f"SELECT * FROM {DEVICE_ROWS} AS d(device, category, controllable)",
    # (signal, UTC day) groups; every sample keeps its 0-based position in the bucket
    "v_bucket_rows": """SELECT pv, ts_ns // 86400000000000 AS day_no, ts_ns, value,
        row_number() OVER (PARTITION BY pv, ts_ns // 86400000000000 ORDER BY ts_ns) - 1 AS pos,
        min(ts_ns) OVER (PARTITION BY pv, ts_ns // 86400000000000) AS first_ns,
        max(ts_ns) OVER (PARTITION BY pv, ts_ns // 86400000000000) AS last_ns FROM v_samples""",
    "v_buckets": """SELECT pv || '-' || CAST(first_ns // 1000000000 AS VARCHAR) || '-'
            || CAST(first_ns % 1000000000 AS VARCHAR) AS bucket_id, pv, day_no, first_ns, last_ns,
        CAST(count(*) AS BIGINT) AS sample_count FROM v_bucket_rows GROUP BY pv, day_no, first_ns, last_ns""",
}

_NEEDS = {
    "v_raw_long": ["v_raw"],
    "v_requests_long": ["v_requests"],
    "v_clock_buckets": ["v_requests_long"],
    "v_user_pvs": ["v_samples"],
    "v_bucket_rows": ["v_samples"],
    "v_buckets": ["v_bucket_rows"],
    "v_typed_buckets": ["v_typed"],
}


def oracle(body: str) -> str:
    """SQL with the views it names as common table expressions in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for parent in _NEEDS.get(name, []):
            need(parent)
        if name not in order:
            order.append(name)

    for name in re.findall(r"\bv_\w+", body):
        if name in SQL:
            need(name)
    if not order:
        return body
    views = ",\n".join(f"{n} AS MATERIALIZED ({SQL[n]})" for n in order)
    head, rest = ("WITH ", body)
    if body.lstrip().upper().startswith("WITH "):
        head, rest = "WITH ", ", " + body.lstrip()[5:]
        return head + views + rest
    return head + views + "\n" + rest
