"""Registration, validation and creation of records."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronolode.operators import annotations, datasets, ingest
from chronolode.queries import views as v
from chronolode.queries.views import oracle


def q_register_providers(spark, sf):
    """Every third name is new; all others come again, twice, with other attributes."""
    known = v.v_providers(spark, sf)
    n = F.substring("provider_id", 6, 20).cast("bigint")
    incoming = known.select(
        F.when(n % 3 == 0, F.concat("name", F.lit("-new"))).otherwise(F.col("name")).alias("name"),
        F.lit("again").alias("description"),
        F.array(F.lit("t")).alias("tags"),
        F.col("attributes"),
        n.alias("seq"),
    )
    twice = incoming.unionByName(incoming.withColumn("description", F.lit("last")).withColumn("seq", F.col("seq") + 10**9))
    out = ingest.register_providers(known, twice)
    made = F.col("provider_id").startswith("prov-")
    return out.select("name", F.when(made, F.col("provider_id")).alias("kept_id"), "description", F.array_join("tags", ",").alias("tags"), "is_new")


def _checked(spark, sf):
    return ingest.validate_requests(v.v_requests(spark, sf), v.v_providers(spark, sf))


def q_validate_requests(spark, sf):
    return _checked(spark, sf).select("request_id", "status", "message", "num_rows", "num_columns")


def q_request_status(spark, sf):
    status = ingest.request_status(_checked(spark, sf))
    return status.select(
        "provider_id", "request_id", "status", "message", F.array_join(F.array_sort("bucket_ids"), ",").alias("bucket_ids"), "update_ns"
    )


def q_create_datasets(spark, sf):
    """Some lack a name, an owner, blocks or an end."""
    k = F.col("dataset_id")
    incoming = v.v_datasets(spark, sf).select(
        k.alias("k"),
        F.when(k % 11 != 0, F.col("name")).alias("name"),
        F.when(k % 13 == 0, F.lit("")).otherwise(F.col("owner")).alias("owner"),
        "description",
        F.when(k % 17 == 0, F.slice("blocks", 1, 0))
        .when(k % 19 == 0, F.transform("blocks", lambda b: b.withField("end_ns", F.lit(None).cast("bigint"))))
        .otherwise(F.transform("blocks", lambda b: b.withField("pvs", F.coalesce(b["pvs"], F.array(F.lit("x"))))))
        .alias("blocks"),
    )
    out = datasets.create_datasets(incoming)
    return out.select("k", "status", "message", F.length("dataset_id").alias("id_length"))


def q_create_annotations(spark, sf):
    k = F.col("annotation_id")
    incoming = v.v_annotations(spark, sf).select(
        k.alias("k"),
        F.when(k % 7 != 0, F.col("owner")).alias("owner"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.col("name")).alias("name"),
        F.when(k % 3 == 0, F.slice("dataset_ids", 1, 0)).otherwise(F.col("dataset_ids")).alias("dataset_ids"),
    )
    out = annotations.create_annotations(incoming)
    sharing = F.count("annotation_id").over(Window.partitionBy("annotation_id"))
    return out.select("k", "status", "message", F.length("annotation_id").alias("id_length"), sharing.alias("n_with_id"))


_MESSAGE = """CASE WHEN provider_id = '' THEN 'provider id missing'
    WHEN provider_id NOT IN (SELECT provider_id FROM v_providers) THEN 'unknown provider'
    WHEN declared <> 4 THEN 'inconsistent dimensions' ELSE '' END"""

QUERIES = {
    "register_providers": (
        q_register_providers,
        oracle(
            """WITH p AS (SELECT *, CAST(substr(provider_id, 6) AS BIGINT) AS n FROM v_providers)
            SELECT name, provider_id AS kept_id, CASE WHEN n % 3 = 0 THEN description ELSE 'last' END AS description,
            CASE WHEN n % 3 = 0 THEN tag1 || ',' || tag2 ELSE 't' END AS tags, false AS is_new FROM p
            UNION ALL SELECT name || '-new', NULL, 'last', 't', true FROM p WHERE n % 3 = 0"""
        ),
    ),
    "validate_requests": (
        q_validate_requests,
        oracle(
            f"""SELECT request_id, CASE WHEN m = '' THEN 'ACCEPTED' ELSE 'REJECTED' END AS status, m AS message,
            CASE WHEN m = '' THEN declared END AS num_rows, CASE WHEN m = '' THEN n_columns END AS num_columns
            FROM (SELECT *, {_MESSAGE} AS m FROM v_requests)"""
        ),
    ),
    "request_status": (
        q_request_status,
        oracle(
            f"""WITH b AS (SELECT lid, string_agg(bucket_id, ',' ORDER BY bucket_id) AS ids FROM v_clock_buckets
              GROUP BY lid)
            SELECT provider_id, request_id, CASE WHEN m = '' THEN 'SUCCESS' ELSE 'REJECTED' END AS status, m AS message,
            CASE WHEN m = '' THEN ids ELSE '' END AS bucket_ids, start_ns AS update_ns
            FROM (SELECT *, {_MESSAGE} AS m FROM v_requests) JOIN b USING (lid)"""
        ),
    ),
    "create_datasets": (
        q_create_datasets,
        oracle(
            """SELECT k, CASE WHEN m = '' THEN 'CREATED' ELSE 'REJECT' END AS status, m AS message,
            CASE WHEN m = '' THEN 64 END AS id_length FROM (SELECT dataset_id AS k, CASE WHEN dataset_id % 11 = 0
              THEN 'name missing' WHEN dataset_id % 13 = 0 THEN 'owner missing' WHEN dataset_id % 17 = 0
              THEN 'no data blocks' WHEN dataset_id % 19 = 0 THEN 'incomplete data block' ELSE '' END AS m
              FROM v_datasets)"""
        ),
    ),
    "create_annotations": (
        q_create_annotations,
        oracle(
            """SELECT k, CASE WHEN m = '' THEN 'CREATED' ELSE 'REJECT' END AS status, m AS message,
            CASE WHEN m = '' THEN 64 END AS id_length, CASE WHEN m = '' THEN 1 ELSE 0 END AS n_with_id
            FROM (SELECT annotation_id AS k, CASE WHEN annotation_id % 7 = 0
              THEN 'owner missing' WHEN annotation_id % 5 = 0 THEN 'name missing' WHEN annotation_id % 3 = 0
              THEN 'no datasets' ELSE '' END AS m FROM v_annotations)"""
        ),
    ),
}
