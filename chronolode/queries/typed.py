"""Values of any type, conditions of samples, nested values."""

from pyspark.sql import functions as F

from chronolode.operators import nested, stats, typed
from chronolode.queries import views as v
from chronolode.queries.views import oracle


def q_typed_buckets(spark, sf):
    long = F.col("data_type") == "LONG"
    total = F.aggregate("longs", F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x).cast("decimal(38,0)"))
    odd = F.filter("status_runs", lambda r: (r["severity"] != 0) | (r["status"] != 0) | r["message"].isNotNull())
    return v.v_typed_buckets(spark, sf).select(
        "bucket_id",
        "pv",
        "data_type",
        "sample_count",
        F.when(F.col("labels").isNotNull(), F.size("labels").cast("bigint")).alias("n_labels"),
        F.when(long, total.cast("string")).alias("whole_sum"),
        F.when(F.col("data_type") == "BOOLEAN", F.size(F.filter("flags", lambda x: x)).cast("bigint")).alias("n_true"),
        F.coalesce(F.aggregate(odd, F.lit(0), lambda a, r: a + r["n"]), F.lit(0)).cast("bigint").alias("n_odd"),
    )


def q_typed_samples(spark, sf):
    """Every sample taken out of its bucket again."""
    kind, value = F.col("data_type"), F.col("value")
    number = F.nanvl(F.try_variant_get(value, "$", "double"), F.lit(None).cast("double"))
    text = F.when(kind.isin("STRING", "ENUM"), F.try_variant_get(value, "$", "string"))
    text = text.when(kind == "STRUCTURE", F.try_variant_get(value, "$.k", "string")).when(kind != "DOUBLE", F.to_json(value))
    return typed.typed_samples(v.v_typed_buckets(spark, sf), "pv").select(
        "pv", "ts_ns", "data_type", F.when(kind == "DOUBLE", number).alias("number"), text.alias("text"), "severity", "status", "message"
    )


def q_pv_metadata_typed(spark, sf):
    return stats.pv_metadata(v.v_typed_buckets(spark, sf)).drop("last_ts_kind", "last_period_ns")


def q_array_rows(spark, sf):
    values = v.v_nested(spark, sf).select("event_id", F.try_parse_json("nested_json").alias("v"))
    return nested.array_rows(values, "v", "event_id").withColumn("value", F.to_json("value"))


QUERIES = {
    "typed_buckets": (
        q_typed_buckets,
        oracle("SELECT bucket_id, pv, data_type, sample_count, n_labels, whole_sum, n_true, n_odd FROM v_typed_buckets"),
    ),
    "typed_samples": (
        q_typed_samples,
        oracle(
            """SELECT pv, ts_ns, kind AS data_type, CASE WHEN kind = 'DOUBLE' AND NOT isnan(value) THEN value END AS number,
            CASE kind WHEN 'LONG' THEN CAST(whole AS VARCHAR)
              WHEN 'ULONG' THEN CASE WHEN beyond < 18446744073709551616 THEN CAST(beyond AS VARCHAR) END
              WHEN 'BOOLEAN' THEN CAST(flag AS VARCHAR) WHEN 'STRUCTURE' THEN json_extract_string(props, '$.k')
              WHEN 'DOUBLE' THEN NULL ELSE state END AS text, severity, status, message FROM v_typed"""
        ),
    ),
    "array_rows": (
        q_array_rows,
        oracle(
            """WITH e AS (SELECT *, event_id % 4 AS m, json_extract_string(props, '$.k') AS k FROM v_nested)
            SELECT event_id, '$[0]' AS path, 1 AS depth, 'numeric' AS kind, '1' AS value FROM e WHERE m = 0
            UNION ALL SELECT event_id, '$[1][0]', 2, 'numeric', CAST(event_id AS VARCHAR) FROM e WHERE m = 0
            UNION ALL SELECT event_id, '$[1][1].k', 3, 'numeric', k FROM e WHERE m = 0
            UNION ALL SELECT event_id, '$[2]', 1, 'array', '[]' FROM e WHERE m = 0
            UNION ALL SELECT event_id, '$.a.b[0]', 3, 'bool', 'true' FROM e WHERE m = 1
            UNION ALL SELECT event_id, '$.a.b[1]', 3, 'none', 'null' FROM e WHERE m = 1
            UNION ALL SELECT event_id, '$.t', 1, 'string', '"' || event_type || '"' FROM e WHERE m = 1
            UNION ALL SELECT event_id, '$.k', 1, 'numeric', k FROM e WHERE m = 2"""
        ),
    ),
    "pv_metadata_typed": (
        q_pv_metadata_typed,
        oracle(
            """SELECT pv, arg_max(bucket_id, last_ns) AS last_bucket_id, arg_max(data_type, last_ns) AS last_data_type,
            arg_max(sample_count, last_ns) AS last_bucket_sample_count, min(first_ns) AS first_ns, max(last_ns) AS last_ns,
            count(*) AS num_buckets, CAST(sum(sample_count) AS BIGINT) AS total_samples FROM v_typed_buckets GROUP BY pv"""
        ),
    ),
}
