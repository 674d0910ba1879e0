"""Streaming jobs over requests derived from the tables, run until the input is used up."""

from pyspark.sql import functions as F

from chronolode.queries import views as v
from chronolode.queries.views import oracle
from chronolode.session import scratch
from chronolode.streaming import jobs

SINCE_NS = 883_612_800_000_000_000  # 1998-01-01
SUBSCRIBED = [f"PV_{part}_{line}" for part in range(200) for line in range(1, 8)]


def _request_files(spark, sf):
    """The requests as files a stream can pick up."""
    path = scratch(spark, "requests")
    v.v_requests(spark, sf).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def _ingest(spark, sf):
    source, out, checkpoint = _request_files(spark, sf), scratch(spark, "store"), scratch(spark, "progress")
    stream = jobs.request_stream(spark, source, files_per_batch=4)
    jobs.stream_ingest(stream, v.v_providers(spark, sf), out, checkpoint, available_now=True).awaitTermination()
    return source, out, checkpoint


def q_stream_ingest(spark, sf):
    _, out, _ = _ingest(spark, sf)
    buckets = jobs.ingested_buckets(spark, out)
    return buckets.select("bucket_id", "provider_id", "request_id", "first_ns", "sample_count",
                          F.round(F.aggregate("vals", F.lit(0.0), lambda a, x: a + x), 4).alias("value_sum"))


def q_stream_status(spark, sf):
    _, out, _ = _ingest(spark, sf)
    return jobs.ingested_status(spark, out).select("request_id", "status", F.size("bucket_ids").alias("n_buckets"))


def q_stream_subscribe(spark, sf):
    out, checkpoint = scratch(spark, "subscribed"), scratch(spark, "progress")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    stream = jobs.request_stream(spark, _request_files(spark, sf))
    jobs.stream_subscribe(stream, SUBSCRIBED, SINCE_NS, keep, checkpoint, available_now=True).awaitTermination()
    return spark.read.parquet(out).select("pv", "ts_ns", "value", "received_ns")


def q_stream_resume(spark, sf):
    """A finished import started again on its checkpoint with more files: only these are read."""
    source, out, checkpoint = _ingest(spark, sf)
    again = v.v_requests(spark, sf).withColumn("request_id", F.concat(F.lit("again-"), "request_id"))
    again.write.mode("append").option("compression", "zstd").parquet(source)
    stream = jobs.request_stream(spark, source, files_per_batch=4)
    jobs.stream_ingest(stream, v.v_providers(spark, sf), out, checkpoint, available_now=True).awaitTermination()
    status = jobs.ingested_status(spark, out)
    return status.groupBy("status", F.col("request_id").startswith("again-").alias("again")).agg(F.count("*").alias("n"))


# a request that arrives twice, equal in all it says, counts once
_ONCE = "SELECT DISTINCT * EXCLUDE (lid) FROM v_requests"
_REJECTED = "(provider_id = '' OR declared <> 4 OR provider_id NOT IN (SELECT provider_id FROM v_providers))"

QUERIES = {
    "stream_ingest": (
        q_stream_ingest,
        oracle(
            """SELECT bucket_id, provider_id, request_id, first_ns, sample_count, round(value_sum, 4) AS value_sum
            FROM v_clock_buckets WHERE sample_count = 4 AND provider_id IN (SELECT provider_id FROM v_providers)
            AND lid IN (SELECT min(lid) FROM v_requests GROUP BY request_id, provider_id, stream_id, suffix, declared, start_ns, period_ns, price, quantity)"""
        ),
    ),
    "stream_status": (
        q_stream_status,
        oracle(
            f"""SELECT request_id, CASE WHEN bad THEN 'REJECTED' ELSE 'SUCCESS' END AS status,
            CASE WHEN bad THEN 0 ELSE n_columns END AS n_buckets FROM (SELECT *, {_REJECTED} AS bad FROM ({_ONCE}))"""
        ),
    ),
    "stream_subscribe": (
        q_stream_subscribe,
        oracle(
            f"""SELECT pv, start_ns + i * period_ns AS ts_ns, value, start_ns AS received_ns FROM v_requests_long
            WHERE start_ns > {SINCE_NS} AND starts_with(pv, 'PV_') AND CAST(split_part(pv, '_', 2) AS INT) < 200"""
        ),
    ),
    "stream_resume": (
        q_stream_resume,
        oracle(
            f"""SELECT CASE WHEN {_REJECTED} THEN 'REJECTED' ELSE 'SUCCESS' END AS status, again, count(*) AS n
            FROM ({_ONCE}) CROSS JOIN (VALUES (false), (true)) AS t(again) GROUP BY 1, 2"""
        ),
    ),
}
