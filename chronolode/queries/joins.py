"""Tables, datasets with their data, annotations with their datasets."""

from pyspark.sql import functions as F

from chronolode.operators import annotations, datasets, ingest, tables
from chronolode.queries import views as v
from chronolode.queries.ranges import BEGIN, END
from chronolode.queries.views import oracle
from chronolode.session import scratch
from chronolode.sources.export import export_bucketed, export_csv

AREAS = ("LI23", "DMPH", "LTUH", "BSY", "LI20", "UNDS")
# users 0 to 14, whose signals exist at every scale; number 7 is written A7
PVS = [f"BPMS_{AREAS[u % 6]}_{'A' if u % 25 == 7 else ''}{u}_X" for u in range(15)]
EXPORTED = 9


def _value(column="value"):
    return F.nanvl(column, F.lit(None)).alias("value")


def q_table_columns(spark, sf):
    table = tables.table_columns(v.v_samples(spark, sf), None, None, PVS)
    return table.select("ts_ns", *[F.nanvl(p, F.lit(None)).alias(p) for p in PVS])


def q_table_rows(spark, sf):
    table = tables.table_rows(v.v_samples(spark, sf), None, None)
    return table.select("ts_ns", F.explode("values").alias("pv", "value")).select("ts_ns", "pv", _value())


def q_table_pattern(spark, sf):
    table = tables.table_pattern(v.v_samples(spark, sf), BEGIN, END, "^QUAD_.*_BCTRL$")
    return table.select("ts_ns", F.explode("values").alias("pv", "value")).select("ts_ns", "pv", _value())


def q_table_to_map(spark, sf):
    table = tables.table_rows(v.v_samples(spark, sf), None, None)
    return tables.table_to_map(table).select("pv", "ts_ns", _value())


def q_dataset_resolve(spark, sf):
    found = datasets.dataset_resolve(v.v_datasets(spark, sf), v.v_samples(spark, sf))
    return found.select("dataset_id", "pv", "ts_ns", _value())


def q_dataset_buckets(spark, sf):
    found = datasets.dataset_buckets(v.v_datasets(spark, sf), v.v_buckets(spark, sf))
    return found.select("dataset_id", "bucket_id", "first_ns", "last_ns", "sample_count")


def q_annotation_datasets(spark, sf):
    found = annotations.annotation_datasets(v.v_annotations(spark, sf), v.v_datasets(spark, sf))
    return found.select(
        "annotation_id", "position", "dataset_id", "dataset_name", "dataset_owner", "description",
        F.size("blocks").alias("n_blocks"),
    )


def q_annotation_links(spark, sf):
    return annotations.annotation_links(v.v_annotations(spark, sf))


def q_validate_provider(spark, sf):
    known = ingest.validate_provider(v.v_requests(spark, sf), v.v_providers(spark, sf))
    return known.select("request_id", "provider_id", "known")


def q_export_csv(spark, sf):
    path = export_csv(v.v_datasets(spark, sf), v.v_samples(spark, sf), EXPORTED, scratch(spark, "csv"))
    table = spark.read.option("header", True).csv(path)
    long = table.unpivot("ts_ns", [c for c in table.columns if c != "ts_ns"], "pv", "text")
    value = F.col("text").try_cast("double")
    return long.where(F.col("text").isNotNull()).select(F.col("ts_ns").cast("bigint"), "pv", F.nanvl(value, F.lit(None)).alias("value"))


def q_export_bucketed(spark, sf):
    path = export_bucketed(v.v_datasets(spark, sf), v.v_buckets(spark, sf), EXPORTED, scratch(spark, "export"))
    return spark.read.parquet(path).select("dataset_id", "bucket_id", "sample_count")


_V = "CASE WHEN isnan(value) THEN NULL ELSE value END"
_RESOLVE = """SELECT DISTINCT dataset_id, pv, ts_ns, event_id, value FROM v_dataset_blocks
    JOIN v_samples USING (user_id) WHERE ts_ns >= begin_ns AND ts_ns < end_ns"""
# every sample once per dataset; lid tells equal samples apart
_RESOLVE_ALL = """SELECT DISTINCT dataset_id, pv, ts_ns, lid, value FROM v_dataset_blocks
    JOIN (SELECT row_number() OVER () AS lid, * FROM v_samples) USING (user_id) WHERE ts_ns >= begin_ns AND ts_ns < end_ns"""
_IN_BUCKET = """SELECT DISTINCT b.dataset_id, k.bucket_id, k.first_ns, k.last_ns, k.sample_count
    FROM v_dataset_blocks b JOIN v_user_pvs USING (user_id) JOIN v_buckets k USING (pv)
    WHERE k.first_ns < b.end_ns AND k.last_ns >= b.begin_ns"""

QUERIES = {
    "table_columns": (
        q_table_columns,
        oracle(
            "SELECT ts_ns, "
            + ", ".join(f"max(CASE WHEN pv = '{p}' THEN {_V} END) AS \"{p}\"" for p in PVS)
            + " FROM v_samples WHERE pv IN ("
            + ", ".join(f"'{p}'" for p in PVS)
            + ") GROUP BY ts_ns"
        ),
    ),
    # one value per signal and instant: the largest, and NaN only where there is no other
    "table_rows": (q_table_rows, oracle(f"SELECT ts_ns, pv, max({_V}) AS value FROM v_samples GROUP BY ts_ns, pv")),
    "table_pattern": (
        q_table_pattern,
        oracle(
            f"""SELECT ts_ns, pv, {_V} AS value FROM v_samples WHERE regexp_matches(pv, '^QUAD_.*_BCTRL$')
            AND ts_ns >= {BEGIN} AND ts_ns < {END}"""
        ),
    ),
    "table_to_map": (
        q_table_to_map,
        oracle(f"SELECT pv, ts_ns, max({_V}) AS value FROM v_samples GROUP BY pv, ts_ns"),
    ),
    "dataset_resolve": (
        q_dataset_resolve,
        oracle(f"SELECT dataset_id, pv, ts_ns, {_V} AS value FROM ({_RESOLVE_ALL})"),
    ),
    "dataset_buckets": (q_dataset_buckets, oracle(_IN_BUCKET)),
    "annotation_datasets": (
        q_annotation_datasets,
        oracle(
            """SELECT a.annotation_id, 0 AS position, a.dataset_id, d.name AS dataset_name, d.owner AS dataset_owner,
            d.description, CASE WHEN d.name IS NULL THEN NULL ELSE 2 END AS n_blocks
            FROM v_annotations a LEFT JOIN v_datasets d USING (dataset_id)"""
        ),
    ),
    "annotation_links": (
        q_annotation_links,
        oracle("SELECT linked_id AS annotation_id, annotation_id AS linked_by FROM v_annotations WHERE linked_id IS NOT NULL"),
    ),
    "validate_provider": (
        q_validate_provider,
        oracle(
            """SELECT request_id, provider_id, provider_id IN (SELECT provider_id FROM v_providers) AS known
            FROM v_requests"""
        ),
    ),
    "export_csv": (
        q_export_csv,
        oracle(f"SELECT ts_ns, pv, {_V} AS value FROM ({_RESOLVE}) WHERE dataset_id = {EXPORTED}"),
    ),
    "export_bucketed": (
        q_export_bucketed,
        oracle(f"SELECT dataset_id, bucket_id, sample_count FROM ({_IN_BUCKET}) WHERE dataset_id = {EXPORTED}"),
    ),
}
