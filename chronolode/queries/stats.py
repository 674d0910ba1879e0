"""Aggregations."""

from pyspark.sql import functions as F

from chronolode.operators import datasets, ingest, median, stats
from chronolode.operators.buckets import pack_buckets
from chronolode.plans import jobs
from chronolode.queries import views as v
from chronolode.queries.ranges import BEGIN, END
from chronolode.queries.views import oracle
from chronolode.session import scratch
from chronolode.sources.store import save_buckets


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _plain(df, *columns):
    """Numbers rounded and NULL where they are none; ``odd`` names those that are Inf or NaN, as engines write them apart."""
    inf = float("inf")
    odd = F.concat_ws(",", *[F.when(F.isnan(c), f"{c}=nan").when(F.col(c) == inf, f"{c}=inf").when(F.col(c) == -inf, f"{c}=-inf") for c in columns])
    finite = {c: F.when(F.abs(c) < inf, F.round(c, 6)) for c in columns}
    return df.withColumn("odd", odd).withColumns(finite)


def q_pv_statistics(spark, sf):
    return _plain(stats.pv_statistics(v.v_samples(spark, sf)), "mean", "median", "std_dev", "min", "max")


def q_pv_statistics_hot(spark, sf):
    """The same with every signal treated as hot: all medians come from the second scan."""
    return _plain(stats.pv_statistics(v.v_samples(spark, sf), hot_samples=0), "mean", "median", "std_dev", "min", "max")


def q_radix_median(spark, sf):
    """Exact median over whole columns with few groups, each holding a large share of the rows."""
    items = v.table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("pv"), F.col("l_extendedprice").alias("value")
    )
    return _rounded(median.radix_median(items, small_rest=50), "median")


def q_statistics_window(spark, sf):
    store = scratch(spark, "store")
    save_buckets(pack_buckets(v.v_samples(spark, sf)), store, "overwrite")
    out = jobs.statistics_of_window(spark.read.parquet(store), BEGIN, END, pattern="^BPMS_", max_span_days=1)
    return _plain(out, "mean", "median", "std_dev", "min", "max")


def q_table_summary(spark, sf):
    return _plain(stats.table_summary(v.v_samples(spark, sf)), "mean", "min", "max")


def q_data_summary(spark, sf):
    out = stats.data_summary(v.v_samples(spark, sf))
    return out.withColumns({c: F.nanvl(c, F.lit(None)) for c in ("first_value", "last_value")})


def q_quality_counts(spark, sf):
    return _rounded(stats.quality_counts(v.v_samples(spark, sf)), "ratio")


def q_quality_tags(spark, sf):
    tagged = stats.quality_tags(stats.quality_counts(v.v_samples(spark, sf)))
    return tagged.select("pv", F.array_join("tags", ",").alias("tags"))


def q_archive_quality(spark, sf):
    points = v.v_points(spark, sf).withColumn("pv", F.concat_ws("-", "name", F.col("event_id") % 7))
    out = stats.archive_quality(points.withColumn("enums", F.col("name") == "view"), has_enums="enums")
    return _rounded(out, "valid_pct").withColumn("tags", F.array_join("tags", ","))


def q_pv_metadata(spark, sf):
    return stats.pv_metadata(v.v_buckets(spark, sf))


def q_pv_list(spark, sf):
    return stats.pv_list(v.v_buckets(spark, sf), "^BPMS.*_X$")


def q_provider_metadata(spark, sf):
    return stats.provider_metadata(v.v_clock_buckets(spark, sf))


def q_provider_pvs(spark, sf):
    return stats.provider_pvs(v.v_clock_buckets(spark, sf))


def q_dataset_extent(spark, sf):
    return datasets.dataset_extent(v.v_datasets(spark, sf))


def q_dataset_pvs(spark, sf):
    return datasets.dataset_pvs(v.v_datasets(spark, sf)).select("dataset_id", F.array_join("pvs", ",").alias("pvs"))


def q_ingest_summary(spark, sf):
    log = v.v_files(spark, sf).withColumn("signals", F.col("file_no") % 50)
    out = stats.ingest_summary(log)
    return _rounded(out, "success_pct", "total_gb", "files_per_sec", "gb_per_sec")


def q_ingest_ema(spark, sf):
    log = v.v_files(spark, sf).withColumn("run", F.col("file_no") % 3)
    return _rounded(stats.ingest_ema(log, "run", ["done_us", "file_no"]), "ema")


def q_stream_summary(spark, sf):
    checked = ingest.validate_requests(v.v_requests(spark, sf), v.v_providers(spark, sf))
    answers = ingest.ingest_stream_summary(checked)
    lists = {name: F.array_join(name, ",") for name in ("request_ids", "rejected_ids")}
    return answers.withColumns({"day": F.col("day").cast("string"), **lists})


def q_stream_requests(spark, sf):
    checked = ingest.validate_requests(v.v_requests(spark, sf), v.v_providers(spark, sf))
    return ingest.ingest_stream_requests(checked)


_P = "CASE WHEN isnan(value) THEN NULL ELSE value END"
# Inf carries over to the mean and makes the deviation NaN; some engines refuse to say so
_F = "CASE WHEN isfinite(value) THEN value END"
_MEAN = f"CASE WHEN bool_or(isinf(value)) THEN sum(CASE WHEN isinf(value) THEN value END) ELSE avg({_F}) END"
_DEVIATION = f"CASE WHEN bool_or(isinf(value)) THEN 'nan'::DOUBLE ELSE stddev_pop({_F}) END"


def _plain_sql(body: str, keys: str, *columns: str) -> str:
    """The twin of ``_plain`` over a query."""
    odd = ", ".join(
        f"CASE WHEN isnan({c}) THEN '{c}=nan' WHEN {c} = 'inf'::DOUBLE THEN '{c}=inf' WHEN {c} = '-inf'::DOUBLE THEN '{c}=-inf' END"
        for c in columns
    )
    finite = ", ".join(f"CASE WHEN isfinite({c}) THEN round({c}, 6) END AS {c}" for c in columns)
    return f"SELECT {keys}, {finite}, concat_ws(',', {odd}) AS odd FROM ({body})"


def _stats_sql(where: str = "true") -> str:
    body = f"""SELECT pv, count({_P}) AS count, CAST(sum(CASE WHEN isnan(value) THEN 1 ELSE 0 END) AS BIGINT) AS nan_count,
        {_MEAN} AS mean, median({_P}) AS median, {_DEVIATION} AS std_dev, min({_P}) AS min, max({_P}) AS max
        FROM v_samples WHERE {where} GROUP BY pv"""
    return _plain_sql(body, "pv, count, nan_count", "mean", "median", "std_dev", "min", "max")


_VALID = "isfinite(value) AND severity < 3"
_REJECTED = "provider_id = '' OR declared <> 4 OR provider_id NOT IN (SELECT provider_id FROM v_providers)"

QUERIES = {
    "pv_statistics": (q_pv_statistics, oracle(_stats_sql())),
    "pv_statistics_hot": (q_pv_statistics_hot, oracle(_stats_sql())),
    "radix_median": (
        q_radix_median,
        """SELECT l_returnflag || l_linestatus AS pv, round(median(l_extendedprice), 6) AS median
        FROM lineitem GROUP BY ALL""",
    ),
    "statistics_window": (
        q_statistics_window,
        oracle(_stats_sql(f"ts_ns >= {BEGIN} AND ts_ns < {END} AND starts_with(pv, 'BPMS_')")),
    ),
    "table_summary": (
        q_table_summary,
        oracle(
            _plain_sql(
                f"SELECT pv, count({_P}) AS count, min({_P}) AS min, max({_P}) AS max, {_MEAN} AS mean FROM v_samples GROUP BY pv",
                "pv, count", "mean", "min", "max",
            )
        ),
    ),
    "data_summary": (
        q_data_summary,
        oracle(
            """WITH e AS (SELECT pv, min(ts_ns) AS lo, max(ts_ns) AS hi, count(*) AS points FROM v_samples GROUP BY pv)
            SELECT e.pv, points, CASE WHEN isnan(a.value) THEN NULL ELSE a.value END AS first_value,
            CASE WHEN isnan(b.value) THEN NULL ELSE b.value END AS last_value FROM e
            JOIN v_samples a ON a.pv = e.pv AND a.ts_ns = lo JOIN v_samples b ON b.pv = e.pv AND b.ts_ns = hi"""
        ),
    ),
    "quality_counts": (
        q_quality_counts,
        oracle(
            """SELECT pv, count(*) FILTER (isfinite(value)) AS valid, count(*) FILTER (isnan(value)) AS nan,
            count(*) FILTER (isinf(value)) AS inf, round(count(*) FILTER (isfinite(value)) / count(*), 6) AS ratio
            FROM v_samples GROUP BY pv"""
        ),
    ),
    "quality_tags": (
        q_quality_tags,
        oracle(
            """SELECT pv, 'h5_data,accelerator_data,production' || CASE WHEN bool_or(isnan(value)) THEN ',contains_nan'
            ELSE '' END || CASE WHEN bool_or(isinf(value)) THEN ',contains_inf' ELSE '' END
            || CASE WHEN bool_and(isfinite(value)) THEN ',all_valid' ELSE '' END AS tags FROM v_samples GROUP BY pv"""
        ),
    ),
    "archive_quality": (
        q_archive_quality,
        oracle(
            f"""SELECT pv, valid_count, total, alarm_count, has_enums, round(100.0 * valid_count / total, 6) AS valid_pct,
            array_to_string(list_filter([CASE WHEN has_enums THEN 'has_enums' END,
              CASE WHEN alarm_count > 0 THEN 'has_alarms' END,
              CASE WHEN valid_count * 10 > total * 9 THEN 'high_quality_data' END,
              CASE WHEN valid_count * 10 < total THEN 'low_quality_data' END], lambda x: x IS NOT NULL), ',') AS tags
            FROM (SELECT name || '-' || CAST(event_id % 7 AS VARCHAR) AS pv, count(*) FILTER ({_VALID}) AS valid_count,
              count(*) AS total, count(*) FILTER (severity > 0) AS alarm_count, bool_or(name = 'view') AS has_enums
              FROM v_points GROUP BY 1)"""
        ),
    ),
    "pv_metadata": (
        q_pv_metadata,
        oracle(
            """WITH l AS (SELECT *, row_number() OVER (PARTITION BY pv ORDER BY last_ns DESC) AS rn FROM v_buckets),
            g AS (SELECT pv, min(first_ns) AS first_ns, max(last_ns) AS last_ns, count(*) AS num_buckets,
              CAST(sum(sample_count) AS BIGINT) AS total_samples FROM v_buckets GROUP BY pv)
            SELECT g.pv, bucket_id AS last_bucket_id, 'DOUBLE' AS last_data_type, 'LIST' AS last_ts_kind,
            sample_count AS last_bucket_sample_count, 0::BIGINT AS last_period_ns, g.first_ns, g.last_ns, num_buckets,
            total_samples FROM g JOIN l ON l.pv = g.pv AND rn = 1"""
        ),
    ),
    "pv_list": (
        q_pv_list,
        oracle(
            """SELECT pv, arg_max(sample_count, last_ns) AS last_bucket_sample_count, count(*) AS num_buckets
            FROM v_buckets WHERE regexp_matches(pv, '^BPMS.*_X$') GROUP BY pv"""
        ),
    ),
    "provider_metadata": (
        q_provider_metadata,
        oracle(
            """SELECT provider_id, count(DISTINCT pv) AS num_pvs, min(first_ns) AS first_ns, max(last_ns) AS last_ns,
            count(*) AS num_buckets FROM v_clock_buckets GROUP BY provider_id"""
        ),
    ),
    "provider_pvs": (q_provider_pvs, oracle("SELECT DISTINCT provider_id, pv FROM v_clock_buckets")),
    "dataset_extent": (
        q_dataset_extent,
        oracle(
            """SELECT dataset_id, min(begin_ns) AS begin_ns, max(end_ns) AS end_ns FROM v_dataset_blocks
            GROUP BY dataset_id"""
        ),
    ),
    "dataset_pvs": (
        q_dataset_pvs,
        oracle(
            """WITH p AS (SELECT user_id, string_agg(pv, ',' ORDER BY pv) AS pvs FROM v_user_pvs GROUP BY user_id)
            SELECT dataset_id, pvs || ',' || pvs AS pvs FROM v_datasets LEFT JOIN p USING (user_id)"""
        ),
    ),
    "ingest_summary": (
        q_ingest_summary,
        oracle(
            """SELECT ok_n AS files_ok, bad_n AS files_failed, round(100.0 * ok_n / (ok_n + bad_n), 6) AS success_pct,
            signals, round(bytes / 1073741824, 6) AS total_gb, round(ok_n / sec, 6) AS files_per_sec,
            round(bytes / 1073741824 / sec, 6) AS gb_per_sec
            FROM (SELECT count(*) FILTER (ok) AS ok_n, count(*) FILTER (NOT ok) AS bad_n,
              CAST(sum(file_no % 50) FILTER (ok) AS BIGINT) AS signals, CAST(sum(file_bytes) AS DOUBLE) AS bytes,
              sum(seconds) AS sec FROM v_files)"""
        ),
    ),
    "ingest_ema": (
        q_ingest_ema,
        oracle(
            """SELECT run, round(sum(0.1::DOUBLE * pow(0.9::DOUBLE, later) * least(seconds, 300)), 6) AS ema
            FROM (SELECT file_no % 3 AS run, seconds, row_number() OVER (PARTITION BY file_no % 3
              ORDER BY done_us DESC, file_no DESC) - 1 AS later FROM v_files) GROUP BY run"""
        ),
    ),
    "ingest_stream_summary": (
        q_stream_summary,
        oracle(
            # ids of a stream by day of receipt, numbers of the whole stream
            f"""WITH r AS (SELECT *, {_REJECTED} AS bad, CAST(CAST(make_timestamp(start_ns // 1000) AS DATE) AS VARCHAR) AS day FROM v_requests),
            whole AS (SELECT stream_id, count(*) AS num_requests, count(*) FILTER (bad) AS num_rejected,
              count(*) FILTER (NOT bad) AS num_accepted, bool_or(bad) AS exceptional FROM r GROUP BY stream_id),
            parts AS (SELECT stream_id, day, string_agg(request_id, ',' ORDER BY start_ns, request_id) AS request_ids,
              coalesce(string_agg(request_id, ',' ORDER BY start_ns, request_id) FILTER (bad), '') AS rejected_ids FROM r GROUP BY stream_id, day)
            SELECT * FROM parts JOIN whole USING (stream_id)"""
        ),
    ),
    "ingest_stream_requests": (
        q_stream_requests,
        oracle(f"SELECT stream_id, request_id, {_REJECTED} AS rejected FROM v_requests"),
    ),
}
