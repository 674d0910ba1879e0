"""Attributes, heterogeneous values, structures, images, records."""

from pyspark.sql import functions as F

from chronolode.functions import values as f
from chronolode.queries import views as v
from chronolode.queries.views import oracle


def _attributes(spark, sf):
    """Pairs with a repeated key."""

    def pair(key, value):
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    pairs = F.array(
        pair("nation", F.col("attributes")["nation"]), pair("name", F.col("name")), pair("nation", F.upper("provider_id"))
    )
    return v.v_providers(spark, sf).select("provider_id", "name", "attributes", pairs.alias("pairs"))


def _text(pairs):
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), p["value"])), ";")


def q_attr_to_map(spark, sf):
    m = f.attr_to_map(F.col("pairs"))
    return _attributes(spark, sf).select("provider_id", m["nation"].alias("nation"), F.size(m).alias("n"))


def q_map_to_attr(spark, sf):
    m = F.map_concat("attributes", F.create_map(F.lit("a"), F.col("name")))
    return _attributes(spark, sf).select("provider_id", _text(f.map_to_attr(m)).alias("pairs"))


def q_attr_find(spark, sf):
    return _attributes(spark, sf).select(
        "provider_id", f.attr_find(F.col("pairs"), "nation").alias("nation"), f.attr_find(F.col("pairs"), "none").alias("missing")
    )


def q_attr_upsert(spark, sf):
    return _attributes(spark, sf).select(
        "provider_id",
        _text(f.attr_upsert(F.col("pairs"), "nation", "X")).alias("updated"),
        _text(f.attr_upsert(F.col("pairs"), "new", F.col("name"))).alias("added"),
    )


def _variants(spark, sf):
    return v.v_values(spark, sf).withColumn("v", F.try_parse_json("value_json"))


def q_value_as_double(spark, sf):
    number = f.value_as_double(F.col("v"))
    return _variants(spark, sf).select(
        "event_id", F.nanvl(number, F.lit(None)).alias("value"), F.isnan(number).alias("nan"),
        f.value_as_double(F.col("v"), "null").alias("lookup"),
        f.value_as_string(F.col("v")).alias("text"), f.value_as_bool(F.col("v")).alias("flag"),
    )


def q_value_kind(spark, sf):
    missing = F.when(F.col("event_id") % 5 != 0, F.col("v"))
    return _variants(spark, sf).select("event_id", f.value_kind(missing).alias("kind"), f.value_is_set(missing).alias("is_set"))


def q_value_status(spark, sf):
    code = F.when(F.col("event_id") % 3 == 0, F.col("status"))
    with_status = f.value_status(F.col("value"), code, F.col("severity"), F.lit(None).cast("string"))
    return v.v_points(spark, sf).select("event_id", with_status.alias("s")).select(
        "event_id", f.has_status(F.col("s")).alias("has"), F.col("s.status.status_code").alias("code"),
        F.col("s.status.severity").alias("severity"),
    )


def _fields(spark, sf):
    extra = F.array(F.struct(F.lit("id").alias("key"), F.col("event_id").cast("string").alias("value")))
    return v.v_values(spark, sf).select("event_id", F.concat(f.json_fields(F.col("props")), extra, extra).alias("fields"))


def q_struct_get(spark, sf):
    return _fields(spark, sf).select("event_id", f.struct_get(F.col("fields"), "k").alias("k"), f.struct_get(F.col("fields"), "z").alias("z"))


def q_struct_has(spark, sf):
    return _fields(spark, sf).select("event_id", f.struct_has(F.col("fields"), "k").alias("k"), f.struct_has(F.col("fields"), "z").alias("z"))


def q_struct_names(spark, sf):
    return _fields(spark, sf).select("event_id", F.array_join(f.struct_names(F.col("fields")), ",").alias("names"))


def q_struct_to_map(spark, sf):
    m = f.struct_to_map(F.col("fields"))
    return _fields(spark, sf).select("event_id", m["k"].alias("k"), m["id"].alias("id"), F.size(m).alias("n"))


def q_map_to_struct(spark, sf):
    m = f.struct_to_map(F.col("fields"))
    return _fields(spark, sf).select("event_id", _text(f.map_to_struct(m)).alias("fields"))


def q_image_info(spark, sf):
    image = F.encode(F.col("props"), "UTF-8")
    unknown = F.when(F.col("event_id") % 10 == 0, "XYZ").otherwise(F.col("file_type"))
    return v.v_values(spark, sf).select("event_id", f.image_info(image, unknown).alias("i")).select("event_id", "i.*")


def q_json_render(spark, sf):
    record = F.struct("provider_id", "name", F.when(F.col("name").endswith("1"), F.col("description")).alias("description"))
    return v.v_providers(spark, sf).select("provider_id", f.json_render(record).alias("json"))


def q_json_parse(spark, sf):
    parsed = f.json_parse(F.when(F.col("event_id") % 6 == 0, F.lit("{bad")).otherwise(F.col("props")), "k int")
    return v.v_values(spark, sf).select("event_id", parsed.alias("p")).select("event_id", "p.ok", F.col("p.record.k").alias("k"))


def q_result_status(spark, sf):
    names = F.array(*map(F.lit, ("REJECT", "ERROR", "EMPTY", "NOT_READY", "OTHER")))
    code = F.get(names, (F.substring("status_id", 4, 20).cast("int") % 5))
    return v.v_status(spark, sf).select(
        "status_id", f.result_status(code, F.col("message")).alias("text"), f.is_error(code).alias("error"),
        f.is_empty(code).alias("empty"),
    )


_NUMERIC = "event_id % 4 = 0"
_K = "props::JSON ->> '$.k'"

QUERIES = {
    "attr_to_map": (q_attr_to_map, oracle("SELECT provider_id, upper(provider_id) AS nation, 2 AS n FROM v_providers")),
    "map_to_attr": (
        q_map_to_attr,
        oracle("SELECT provider_id, 'a=' || name || ';nation=' || attr_value AS pairs FROM v_providers"),
    ),
    "attr_find": (
        q_attr_find,
        oracle("SELECT provider_id, attr_value AS nation, CAST(NULL AS VARCHAR) AS missing FROM v_providers"),
    ),
    "attr_upsert": (
        q_attr_upsert,
        oracle(
            """SELECT provider_id, 'nation=X;name=' || name || ';nation=' || upper(provider_id) AS updated,
            'nation=' || attr_value || ';name=' || name || ';nation=' || upper(provider_id) || ';new=' || name AS added
            FROM v_providers"""
        ),
    ),
    "value_as_double": (
        q_value_as_double,
        oracle(
            f"""SELECT event_id, CASE WHEN {_NUMERIC} THEN CAST(value_json AS DOUBLE) END AS value,
            NOT ({_NUMERIC}) AS nan, CASE WHEN {_NUMERIC} THEN CAST(value_json AS DOUBLE) END AS lookup,
            CASE WHEN event_id % 4 = 2 THEN 'txt' END AS text, CASE WHEN event_id % 4 = 1 THEN true END AS flag
            FROM v_values"""
        ),
    ),
    "value_kind": (
        q_value_kind,
        oracle(
            """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'none' ELSE CASE event_id % 4 WHEN 0 THEN 'numeric'
            WHEN 1 THEN 'bool' WHEN 2 THEN 'string' ELSE 'structure' END END AS kind, event_id % 5 <> 0 AS is_set
            FROM v_values"""
        ),
    ),
    "value_status": (
        q_value_status,
        oracle(
            """SELECT event_id, event_id % 3 = 0 AS has, CASE WHEN event_id % 3 = 0 THEN status END AS code,
            CASE WHEN event_id % 3 = 0 THEN severity END AS severity FROM v_points"""
        ),
    ),
    "struct_get": (q_struct_get, oracle(f"SELECT event_id, {_K} AS k, CAST(NULL AS VARCHAR) AS z FROM v_values")),
    "struct_has": (q_struct_has, oracle(f"SELECT event_id, {_K} IS NOT NULL AS k, false AS z FROM v_values")),
    "struct_names": (
        q_struct_names,
        oracle("SELECT event_id, array_to_string(json_keys(props::JSON), ',') || ',id,id' AS names FROM v_values"),
    ),
    "struct_to_map": (
        q_struct_to_map,
        oracle(f"SELECT event_id, {_K} AS k, CAST(event_id AS VARCHAR) AS id, 2 AS n FROM v_values"),
    ),
    "map_to_struct": (
        q_map_to_struct,
        oracle(f"SELECT event_id, 'id=' || CAST(event_id AS VARCHAR) || ';k=' || ({_K}) AS fields FROM v_values"),
    ),
    "image_info": (
        q_image_info,
        oracle(
            """SELECT event_id, CASE t WHEN 'JPEG' THEN 'image/jpeg' WHEN 'PNG' THEN 'image/png' WHEN 'GIF' THEN 'image/gif'
            WHEN 'BMP' THEN 'image/bmp' WHEN 'TIFF' THEN 'image/tiff' WHEN 'SVG' THEN 'image/svg+xml'
            WHEN 'EPS' THEN 'application/postscript' WHEN 'PDF' THEN 'application/pdf'
            ELSE 'application/octet-stream' END AS mime, CASE t WHEN 'JPEG' THEN '.jpg' WHEN 'XYZ' THEN '.raw'
            ELSE '.' || lower(t) END AS ext, CAST(strlen(props) AS INT) AS bytes, t <> 'XYZ' AS valid
            FROM (SELECT event_id, props, CASE WHEN event_id % 10 = 0 THEN 'XYZ' ELSE file_type END AS t FROM v_values)"""
        ),
    ),
    "json_render": (
        q_json_render,
        oracle(
            """SELECT provider_id, '{"provider_id":"' || provider_id || '","name":"' || name || '","description":'
            || CASE WHEN name LIKE '%1' THEN '"' || description || '"' ELSE 'null' END || '}' AS json FROM v_providers"""
        ),
    ),
    "json_parse": (
        q_json_parse,
        oracle(
            f"""SELECT event_id, event_id % 6 <> 0 AS ok, CASE WHEN event_id % 6 <> 0 THEN CAST({_K} AS INT) END AS k
            FROM v_values"""
        ),
    ),
    "result_status": (
        q_result_status,
        oracle(
            """SELECT status_id, ['REJECTED', 'ERROR', 'EMPTY', 'NOT_READY', 'UNKNOWN'][c + 1] || ': ' || message AS text,
            c = 1 AS error, c = 2 AS empty
            FROM (SELECT *, CAST(substr(status_id, 4) AS INT) % 5 AS c FROM v_status)"""
        ),
    ),
}
