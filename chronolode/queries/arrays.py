"""Columns of buckets as arrays."""

from pyspark.sql import functions as F

from chronolode.functions import values
from chronolode.operators import annotations, buckets
from chronolode.queries import views as v
from chronolode.queries.views import oracle


def q_column_merge(spark, sf):
    merged = buckets.column_merge(v.v_buckets(spark, sf))
    return merged.select("pv", "pos", F.nanvl("value", F.lit(None)).alias("value"))


def q_tag_union(spark, sf):
    tags = v.v_providers(spark, sf).withColumn("more", F.array(F.lit("credit"), F.lit("site"), F.col("name")))
    union = buckets.tag_union(F.col("tags"), F.col("more"))
    return tags.select("provider_id", F.array_join(union, ",").alias("tags"))


def q_array_ops(spark, sf):
    vals = F.col("vals")
    return v.v_clock_buckets(spark, sf).select(
        "bucket_id",
        "request_id",
        values.array_size(vals).alias("n"),
        values.array_get(vals, 0).alias("first"),
        values.array_get(vals, 4).alias("beyond"),
        F.array_join(F.transform(values.array_slice(vals, 2, 9), lambda x: F.round(x, 2).cast("string")), ",").alias("tail"),
        F.size(values.array_slice(vals, 7, 9)).alias("empty"),
    )


def q_column_size(spark, sf):
    return buckets.column_size(v.v_buckets(spark, sf)).select("bucket_id", "n")


def q_calculation_frames(spark, sf):
    """Each accepted request as a calculation of one frame; those of uneven length drop out."""
    frame = F.struct(F.concat(F.lit("frame of "), "stream_id").alias("name"), "ts", "columns")
    calculations = v.v_requests(spark, sf).select(F.col("request_id").alias("calc_id"), F.array(frame).alias("frames"))
    return annotations.calculation_frames(calculations)


QUERIES = {
    "column_merge": (
        q_column_merge,
        oracle(
            # samples of one instant follow each other by value, as in a bucket
            """SELECT pv, row_number() OVER (PARTITION BY pv ORDER BY ts_ns, value NULLS FIRST) - 1 AS pos,
            CASE WHEN isnan(value) THEN NULL ELSE value END AS value FROM v_samples"""
        ),
    ),
    "tag_union": (
        q_tag_union,
        oracle(
            """SELECT provider_id, array_to_string(list_sort(list_distinct([tag1, tag2, 'credit', 'site', name])), ',')
            AS tags FROM v_providers"""
        ),
    ),
    "array_ops": (
        q_array_ops,
        oracle(
            """SELECT pv || '-' || CAST(start_ns // 1000000000 AS VARCHAR) || '-'
            || CAST(start_ns % 1000000000 AS VARCHAR) AS bucket_id, request_id, 4 AS n,
            min(CASE WHEN i = 0 THEN value END) AS first, CAST(NULL AS DOUBLE) AS beyond,
            CAST(round(max(CASE WHEN i = 2 THEN value END), 2) AS VARCHAR) || ','
            || CAST(round(max(CASE WHEN i = 3 THEN value END), 2) AS VARCHAR) AS tail, 0 AS empty
            FROM v_requests_long GROUP BY lid, pv, start_ns, request_id"""
        ),
    ),
    "column_size": (q_column_size, oracle("SELECT bucket_id, CAST(sample_count AS INT) AS n FROM v_buckets")),
    "calculation_frames": (
        q_calculation_frames,
        oracle(
            """SELECT request_id AS calc_id, 'frame of ' || stream_id AS frame, pv AS "column", i AS pos,
            start_ns + i * period_ns AS ts_ns, value FROM v_requests_long WHERE declared = 4"""
        ),
    ),
}
