"""Range queries, pages and criteria."""

from pyspark.sql import functions as F

from chronolode.operators import annotations, buckets, datasets, ingest
from chronolode.queries import views as v
from chronolode.queries.views import oracle
from chronolode.session import scratch
from chronolode.sources.records import read_records, store_datasets

DAY = 86_400_000_000_000
BEGIN = 1_704_067_200_000_000_000 + 3 * DAY + DAY // 2
END = BEGIN + 9 * DAY + 12_345


def _value(column="value"):
    return F.nanvl(column, F.lit(None)).alias("value")


def q_select_pvs(spark, sf):
    samples = v.v_samples(spark, sf)
    named = buckets.select_pvs(samples, "BPMS_LI23_0_X,,QUAD_BSY_3_BCTRL").withColumn("how", F.lit("list"))
    found = buckets.select_pvs(samples, pattern="^(KLYS|TMIT)_.*BR$").withColumn("how", F.lit("pattern"))
    return named.unionByName(found).select("how", "event_id", "pv")


def q_query_buckets(spark, sf):
    found = buckets.query_buckets(v.v_buckets(spark, sf), BEGIN, END, pattern="_(X|BCTRL)$", max_span_days=1)
    return found.select("bucket_id", "first_ns", "last_ns", "sample_count")


def q_pack_buckets_split(spark, sf):
    """Buckets of two samples at most, so that most days are split."""
    packed = buckets.pack_buckets(v.v_samples(spark, sf), 2)
    return packed.select("bucket_id", "pv", "first_ns", "last_ns", "sample_count")


def q_query_samples(spark, sf):
    found = buckets.query_samples(v.v_buckets(spark, sf, status=True), BEGIN, END, max_span_days=1)
    return found.select("pv", "ts_ns", _value(), "severity", "status", "message")


def q_query_pages(spark, sf):
    return buckets.query_pages(v.v_buckets(spark, sf).select(*buckets.PAGE_ORDER), 100)


def q_next_page(spark, sf):
    after = ("KLYS_LI23_0_PHAS_FASTBR", BEGIN, "")
    return buckets.next_page(v.v_buckets(spark, sf).select(*buckets.PAGE_ORDER), 250, after)


def q_providers(spark, sf):
    providers = v.v_providers(spark, sf)
    picks = [
        ("id", dict(id="prov-7")),
        ("text", dict(text="Nation supplier#000000003")),
        ("tag", dict(tag="debit")),
        ("compound", dict(tag="credit", text="provider", attr=("nation", "CHINA"))),
        ("all", {}),
    ]
    return _union(ingest.providers_query, providers, picks, "provider_id")


def _union(query, table, picks, key):
    out = None
    for name, criteria in picks:
        part = query(table, **criteria).select(F.lit(name).alias("pick"), F.col(key).alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


def q_request_status(spark, sf):
    status, providers = v.v_status(spark, sf), v.v_providers(spark, sf)
    begin, end = 852_076_800_000_000_000, 883_612_800_000_000_000  # 1997
    picks = [
        ("provider", dict(provider_id="prov-11")),
        ("name", dict(provider_name="Supplier#000000004", providers=providers)),
        ("request", dict(request_id="req-77")),
        ("errors", dict(statuses=["REJECTED", "ERROR"], begin_ns=begin, end_ns=end)),
    ]
    return _union(ingest.request_status_query, status, picks, "status_id")


def q_datasets(spark, sf):
    picks = [
        ("id", dict(id=12)),
        ("owner", dict(owner="nation-3")),
        ("text", dict(text="BUILDING machinery")),
        ("pv", dict(pv="BPMS_LI23_0_X")),
        ("mixed", dict(owner="nation-3", text="building", pv="BPMS_LI23_0_X")),
        ("all", {}),
    ]
    return _union(datasets.datasets_query, v.v_datasets(spark, sf), picks, "dataset_id")


def q_annotations(spark, sf):
    picks = [
        ("id", dict(id=5)),
        ("owner", dict(owner="src3")),
        ("dataset", dict(dataset=17)),
        ("annotation", dict(annotation=21)),
        ("text", dict(text="that run:")),
        ("words", dict(text="Is note99")),
        ("tag", dict(tag="de")),
        ("compound", dict(owner="src1", tag="en", text="the")),
        ("attribute", dict(attr=("n_chars", "350"))),
        ("all", {}),
    ]
    return _union(annotations.annotations_query, v.v_annotations(spark, sf), picks, "annotation_id")


def q_stored_datasets(spark, sf):
    """All datasets created in two runs, a third of them in both, and read from their table."""
    path, given = scratch(spark, "datasets"), v.v_datasets(spark, sf).drop("dataset_id")
    part = F.pmod(F.xxhash64("name"), F.lit(3))
    for run in (part < 2, part > 0):
        store_datasets(given.where(run), path)
    return read_records(spark, path).select("name", "owner", F.size("blocks").alias("n_blocks"))


def q_exists(spark, sf):
    ids = v.table(spark, sf, "orders").select(F.col("o_custkey").alias("dataset_id")).unionByName(
        v.table(spark, sf, "part").select((F.col("p_partkey") * 3).alias("dataset_id"))
    )
    return datasets.exists_by_id(v.v_datasets(spark, sf), ids, "dataset_id")


def q_column_filter(spark, sf):
    kept = buckets.column_filter(v.v_clock_buckets(spark, sf), lambda x: x > 50_000.5)
    return kept.select("bucket_id", "request_id", F.size("vals").alias("n"), F.round(F.array_min("vals"), 4).alias("lowest"))


def q_column_slice(spark, sf):
    cut = buckets.column_slice(v.v_clock_buckets(spark, sf), 1, 3)
    return cut.select("pv", "request_id", F.posexplode("vals").alias("pos", "value"))


_TOKENS = "string_split_regex(lower({c}), '\\W+')"
_NOTES = [_TOKENS.format(c=c) for c in ("name", "comment", "event_description")]


def _any(words, columns):
    listed = ", ".join(f"'{w}'" for w in words)
    return "(" + " OR ".join(f"list_has_any({c}, [{listed}])" for c in columns) + ")"


_PROV = [_TOKENS.format(c=c) for c in ("name", "description")]
_SETS = _PROV

QUERIES = {
    "select_pvs": (
        q_select_pvs,
        oracle(
            """SELECT 'list' AS how, event_id, pv FROM v_samples WHERE pv IN ('BPMS_LI23_0_X', 'QUAD_BSY_3_BCTRL')
            UNION ALL SELECT 'pattern', event_id, pv FROM v_samples WHERE regexp_matches(pv, '^(KLYS|TMIT)_.*BR$')"""
        ),
    ),
    "query_buckets": (
        q_query_buckets,
        oracle(
            f"""SELECT bucket_id, first_ns, last_ns, sample_count FROM v_buckets
            WHERE first_ns < {END} AND last_ns >= {BEGIN} AND regexp_matches(pv, '_(X|BCTRL)$')"""
        ),
    ),
    "pack_buckets_split": (
        q_pack_buckets_split,
        oracle(
            """SELECT pv || '-' || CAST(min(ts_ns) // 1000000000 AS VARCHAR) || '-'
            || CAST(min(ts_ns) % 1000000000 AS VARCHAR)
            || CASE part WHEN 0 THEN '' ELSE '-' || lpad(CAST(part AS VARCHAR), 9, '0') END AS bucket_id,
            pv, min(ts_ns) AS first_ns, max(ts_ns) AS last_ns, count(*) AS sample_count
            FROM (SELECT *, (row_number() OVER (PARTITION BY pv, day_no ORDER BY ts_ns, value) - 1) // 2 AS part
              FROM (SELECT *, ts_ns // 86400000000000 AS day_no FROM v_samples))
            GROUP BY pv, day_no, part"""
        ),
    ),
    "query_samples": (
        q_query_samples,
        oracle(
            f"""SELECT pv, ts_ns, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, severity, status, message FROM v_samples
            WHERE ts_ns >= {BEGIN} AND ts_ns < {END}"""
        ),
    ),
    "query_pages": (
        q_query_pages,
        oracle(
            """SELECT pv, first_ns, bucket_id, (row_number() OVER (ORDER BY pv, first_ns, bucket_id) - 1) // 100 + 1
            AS page FROM v_buckets"""
        ),
    ),
    "next_page": (
        q_next_page,
        oracle(
            f"""SELECT pv, first_ns, bucket_id FROM v_buckets
            WHERE (pv, first_ns, bucket_id) > ('KLYS_LI23_0_PHAS_FASTBR', {BEGIN}, '')
            ORDER BY pv, first_ns, bucket_id LIMIT 250"""
        ),
    ),
    "providers_query": (
        q_providers,
        oracle(
            f"""SELECT 'id' AS pick, provider_id AS id FROM v_providers WHERE provider_id = 'prov-7'
            UNION ALL SELECT 'text', provider_id FROM v_providers WHERE {_any(["nation", "supplier", "000000003"], _PROV)}
            UNION ALL SELECT 'tag', provider_id FROM v_providers WHERE tag1 = 'debit' OR tag2 = 'debit'
            UNION ALL SELECT 'compound', provider_id FROM v_providers WHERE (tag1 = 'credit' OR tag2 = 'credit')
              AND {_any(["provider"], _PROV)} AND attr_name = 'nation' AND attr_value = 'CHINA'
            UNION ALL SELECT 'all', provider_id FROM v_providers"""
        ),
    ),
    "request_status_query": (
        q_request_status,
        oracle(
            """SELECT 'provider' AS pick, status_id AS id FROM v_status WHERE provider_id = 'prov-11'
            UNION ALL SELECT 'name', status_id FROM v_status WHERE provider_id IN
              (SELECT provider_id FROM v_providers WHERE name = 'Supplier#000000004')
            UNION ALL SELECT 'request', status_id FROM v_status WHERE request_id = 'req-77'
            UNION ALL SELECT 'errors', status_id FROM v_status WHERE status IN ('REJECTED', 'ERROR')
              AND update_ns >= epoch_ns(TIMESTAMP '1997-01-01') AND update_ns < epoch_ns(TIMESTAMP '1998-01-01')"""
        ),
    ),
    "datasets_query": (
        q_datasets,
        oracle(
            f"""WITH hit AS (SELECT dataset_id FROM v_datasets JOIN v_user_pvs USING (user_id) WHERE pv = 'BPMS_LI23_0_X')
            SELECT 'id' AS pick, dataset_id AS id FROM v_datasets WHERE dataset_id = 12
            UNION ALL SELECT 'owner', dataset_id FROM v_datasets WHERE owner = 'nation-3'
            UNION ALL SELECT 'text', dataset_id FROM v_datasets WHERE {_any(["building", "machinery"], _SETS)}
            UNION ALL SELECT 'pv', dataset_id FROM hit
            UNION ALL SELECT 'mixed', dataset_id FROM v_datasets WHERE owner = 'nation-3'
              AND ({_any(["building"], _SETS)} OR dataset_id IN (SELECT dataset_id FROM hit))
            UNION ALL SELECT 'all', dataset_id FROM v_datasets"""
        ),
    ),
    "annotations_query": (
        q_annotations,
        oracle(
            f"""SELECT 'id' AS pick, annotation_id AS id FROM v_annotations WHERE annotation_id = 5
            UNION ALL SELECT 'owner', annotation_id FROM v_annotations WHERE owner = 'src3'
            UNION ALL SELECT 'dataset', annotation_id FROM v_annotations WHERE dataset_id = 17
            UNION ALL SELECT 'annotation', annotation_id FROM v_annotations WHERE linked_id = 21
            UNION ALL SELECT 'text', annotation_id FROM v_annotations WHERE {_any(["that", "run"], _NOTES)}
            UNION ALL SELECT 'words', annotation_id FROM v_annotations WHERE {_any(["is", "note99"], _NOTES)}
            UNION ALL SELECT 'tag', annotation_id FROM v_annotations WHERE tag = 'de'
            UNION ALL SELECT 'compound', annotation_id FROM v_annotations WHERE owner = 'src1' AND tag = 'en'
              AND {_any(["the"], _NOTES)}
            UNION ALL SELECT 'attribute', annotation_id FROM v_annotations WHERE attr_value = '350'
            UNION ALL SELECT 'all', annotation_id FROM v_annotations"""
        ),
    ),
    "stored_datasets": (
        q_stored_datasets,
        oracle(
            """SELECT name, owner, CAST(2 AS INT) AS n_blocks FROM v_datasets
            WHERE user_id IN (SELECT user_id FROM v_user_pvs)"""
        ),
    ),
    "exists_by_id": (
        q_exists,
        oracle(
            """SELECT id AS dataset_id, id IN (SELECT dataset_id FROM v_datasets) AS found
            FROM (SELECT o_custkey AS id FROM orders UNION SELECT p_partkey * 3 FROM part)"""
        ),
    ),
    "column_filter": (
        q_column_filter,
        oracle(
            """SELECT min(pv) || '-' || CAST(min(start_ns) // 1000000000 AS VARCHAR) || '-'
            || CAST(min(start_ns) % 1000000000 AS VARCHAR) AS bucket_id, request_id, CAST(count(*) AS INT) AS n,
            round(min(value), 4) AS lowest FROM v_requests_long WHERE value > 50000.5 GROUP BY lid, pv, request_id"""
        ),
    ),
    "column_slice": (
        q_column_slice,
        oracle("SELECT pv, request_id, i - 1 AS pos, value FROM v_requests_long WHERE i >= 1 AND i < 3"),
    ),
}
