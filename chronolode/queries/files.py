"""Files, decoded signals and archive JSON."""

from pyspark.sql import functions as F

from chronolode.functions.values import map_to_attr
from chronolode.operators import files
from chronolode.operators.archive import archive_attach_meta, archive_attributes
from chronolode.plans.jobs import archive_requests as import_archive
from chronolode.plans.jobs import import_rejects, import_requests
from chronolode.queries import views as v
from chronolode.queries.views import oracle
from chronolode.session import scratch
from chronolode.sources import archive_json as archive
from chronolode.sources.dictionaries import dim_tables
from chronolode.sources.reader import parse_answer_lines, read_signal_files
from chronolode.sources.store import write_buckets


def _pairs(column) -> F.Column:
    """Map as text ``k=v;k=v`` ordered by key."""
    return F.array_join(F.transform(map_to_attr(column), lambda p: F.concat(p["key"], F.lit("="), p["value"])), ";")


IMPORT_LIMITS = {"min_file_bytes": 20 * 1024, "max_objects": files.MAX_OBJECTS, "max_samples": 8}


def q_import_requests(spark, sf):
    raw = v.v_raw(spark, sf, "secs", "nanos", "dims", "vals")
    requests = import_requests(raw, "provider-1", 0, **IMPORT_LIMITS)
    column = F.get("columns", 0)
    total = F.aggregate(column["vals"], F.lit(0.0), lambda a, x: a + x)
    return requests.select(
        F.col("stream_id").alias("path"), column["name"].alias("name"), F.col("ts.count").alias("n"),
        F.col("ts.start_ns").alias("start_ns"), F.col("ts.period_ns").alias("period_ns"),
        F.size(column["vals"]).alias("n_vals"), F.round(total, 4).alias("total"),
        F.array_join("tags", ",").alias("tags"), F.col("attributes")["beam_line"].alias("beam_line"),
    )


def q_import_rejects(spark, sf):
    return import_rejects(v.v_raw(spark, sf, "secs", "nanos", "dims"), **IMPORT_LIMITS)


def q_file_admission(spark, sf):
    checked = files.file_admission(v.v_files(spark, sf), files.MIN_FILE_BYTES, files.MAX_FILE_BYTES)
    return checked.select("path", "file_bytes", "admitted", "reason")


def q_file_order(spark, sf):
    return files.file_order(v.v_files(spark, sf).select("path", "file_bytes")).select("path", "file_bytes", "ord")


def q_resume_filter(spark, sf):
    found = v.v_files(spark, sf)
    return files.resume_filter(found, found.where("processed")).select("path", "file_bytes")


def q_signal_catalog(spark, sf):
    return files.signal_catalog(v.v_raw(spark, sf), files.MAX_OBJECTS).select("path", "signal_name")


def q_signal_counts(spark, sf):
    return files.file_signal_counts(v.v_raw(spark, sf), files.MAX_OBJECTS)


def q_signal_cap(spark, sf):
    return files.signal_cap(v.v_raw(spark, sf).select("path", "signal_name", "price"), 2, "price")


def q_signals_by(spark, sf):
    found = files.signals_by(v.v_raw(spark, sf), device="KLYS", project="default")
    return found.select("path", "signal_name", F.col("info.attribute").alias("attribute"))


def q_file_metadata(spark, sf):
    return files.file_metadata_distinct(v.v_raw(spark, sf)).drop("file_ts")


def q_archive_json(spark, sf):
    points = archive.archive_json(v.v_archive_json(spark, sf))
    return points.select(
        "pv", "ts_ns", F.nanvl("val", F.lit(None)).alias("val"), F.isnan("val").alias("nan"), "severity", "status", "error"
    )


def q_archive_meta(spark, sf):
    meta = archive.archive_meta(v.v_archive_json(spark, sf))
    return meta.select("pv", _pairs(F.col("enums")).alias("enums"), _pairs(F.col("properties")).alias("properties"), "description")


def q_archive_attributes(spark, sf):
    meta = archive_attributes(archive.archive_meta(v.v_archive_json(spark, sf)))
    return meta.select("pv", _pairs(F.col("attributes")).alias("attributes"))


def q_archive_attach_meta(spark, sf):
    """Points with the metadata of their own answer, and those of one device with metadata matched by name."""
    answers = v.v_archive_json(spark, sf)
    own = archive.archive_json(answers, meta=True)
    named = archive_attach_meta(archive.archive_json(answers), archive.archive_meta(answers).where("description = 'probe'"))
    columns = ["pv", "ts_ns", "severity", F.col("properties")["EGU"].alias("egu"), F.size("enums").alias("n_enums")]
    return own.select(F.lit("own").alias("how"), *columns).unionByName(named.select(F.lit("name").alias("how"), *columns))


def q_archive_requests(spark, sf):
    requests = import_archive(v.v_archive_json(spark, sf), "prov-1", 7)
    column = F.get("columns", 0)
    total = F.aggregate(F.filter(column["vals"], lambda x: ~F.isnan(x)), F.lit(0.0), lambda a, x: a + x)
    figures = ["epics_egu", "data_valid_count", "data_alarm_count", "has_enums", "signal_type"]
    return requests.select(
        column["name"].alias("pv"),
        F.col("ts.start_ns").alias("start_ns"),
        F.col("ts.period_ns").alias("period_ns"),
        F.col("ts.count").alias("n"),
        total.alias("total"),
        F.array_join("tags", ",").alias("tags"),
        *(F.col("attributes")[k].alias(k) for k in figures),
    )


def _dictionary(spark, sf):
    """Beamline documents: one per supplier, its area named after it, parts as devices."""
    return v.table(spark, sf, "supplier").selectExpr(
        """concat('{"areas":{"A', s_suppkey, '":{"beam_path":["N', s_nationkey, '","B', s_suppkey % 4,
            '"],"description":"', s_name, '","z_range":[', s_suppkey, ',', s_suppkey + 10, '],"sector":',
            CASE WHEN s_suppkey % 3 = 0 THEN concat('["S', s_suppkey % 7, '","S', s_suppkey % 5, '"]')
                 ELSE concat('"S', s_suppkey % 7, '"') END,
            ',"beam_system":"sys","function":"f', s_suppkey % 2, '","devices":{"D1":{"z_position":', s_suppkey + 1,
            ',"z_uncertainty":0.5}}}},"beam_paths":{"P', s_suppkey, '":{"description":"path","sequence":["A', s_suppkey,
            '","A0"],"beam_system":"sys","origin":"o","destination":"d"}},"parent_areas":{"Q', s_suppkey,
            '":{"description":"parent","children":["A', s_suppkey, '"],"z_range":[0,1]}},"sectors":{"S', s_suppkey,
            '":{"z_range":[', s_suppkey, ',', s_suppkey + 1, '],"description":"sec"}}}') AS doc"""
    )


def q_dim_tables(spark, sf):
    dims = dim_tables(_dictionary(spark, sf))

    def row(name, key, a, b):
        return dims[name].select(
            F.lit(name).alias("dim"), F.col(key).alias("k"), a.cast("string").alias("a"), b.cast("double").alias("b")
        )

    none = F.lit(None)
    parts = [
        row("area", "area", F.array_join("beam_path", ","), F.col("z_max")),
        row("area_sector", "area", F.col("sector"), none),
        row("area_device", "area", F.col("location"), F.col("z_position")),
        row("beam_path", "beam_path", F.col("area"), F.col("position")),
        row("parent_area", "parent", F.col("child"), F.col("z_max")),
        row("sector", "sector", F.col("description"), F.col("z_min")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_write_buckets(spark, sf):
    stored = write_buckets(v.v_requests(spark, sf), scratch(spark, "buckets"), "overwrite", folder="month")
    return stored.select(
        "bucket_id", "provider_id", "request_id", "first_ns", "last_ns", "sample_count", "period_ns",
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.round(F.aggregate("vals", F.lit(0.0), lambda a, x: a + x), 4).alias("value_sum"),
    )


_PARSED = """regexp_extract(path, '([^/]*)\\.h5$', 1) AS stem"""
_NAME = "'^([A-Z]+)_([A-Z]+)_([0-9]{8})_([0-9]{6})(?:_([A-Za-z0-9]+))?$'"

_REFUSED = """CASE WHEN file_no % 7 = 0 THEN 'too small'
    WHEN signal_name IN ('secondsPastEpoch', 'nanoseconds') THEN 'time, not a signal'
    WHEN n_objects > 10000 THEN 'too many objects' WHEN file_no % 23 = 0 THEN 'seconds and nanoseconds differ' ELSE '' END"""

def q_signal_files(spark, sf):
    """Archiver answers written as files, some lines cut short, and read by the hook."""
    path = scratch(spark, "answers")
    whole = F.col("user_id") % 11 != 0
    v.v_archive_json(spark, sf).select(F.when(whole, F.col("payload")).otherwise(F.substring("payload", 1, 30))).write.text(path)
    good, bad = read_signal_files(spark, path, parse_answer_lines, "*.txt")
    total = F.aggregate(F.filter("vals", lambda x: ~F.isnan(x)), F.lit(0.0), lambda a, x: a + x)
    found = good.select(F.col("signal_name").alias("name"), F.size("vals").alias("points"), total.alias("total"), F.lit("").alias("reason"))
    missing = bad.select(F.lit(None).cast("string").alias("name"), F.lit(0).alias("points"), F.lit(0.0).alias("total"), "reason")
    return found.unionByName(missing)


QUERIES = {
    "signal_files": (
        q_signal_files,
        oracle(
            """SELECT CASE WHEN user_id % 11 <> 0 THEN pv END AS name,
            CASE WHEN user_id % 11 <> 0 AND user_id % 7 <> 0 THEN 3 ELSE 0 END AS points,
            CASE WHEN user_id % 11 <> 0 AND user_id % 7 <> 0 THEN user_id + 7.5 ELSE 0.0 END AS total,
            CASE WHEN user_id % 11 <> 0 THEN '' ELSE 'signal without a name' END AS reason FROM v_archive_json"""
        ),
    ),
    "import_requests": (
        q_import_requests,
        oracle(
            f"""SELECT path, signal_name AS name, 8 AS n, (1700000000 + file_no * 10) * 1000000000 AS start_ns,
            250000000 AS period_ns, 8 AS n_vals, round(sum(CAST(quantity AS DOUBLE) + i), 4) AS total,
            'h5_data,accelerator_data,production,all_valid' AS tags,
            CASE file_no % 2 WHEN 0 THEN 'CU' ELSE 'SC' END || '_' || CASE file_no % 3 WHEN 0 THEN 'HXR' ELSE 'SXR' END
            AS beam_line FROM v_raw_long WHERE {_REFUSED} = '' GROUP BY lid, path, signal_name, file_no"""
        ),
    ),
    "import_rejects": (
        q_import_rejects,
        oracle(f"SELECT * FROM (SELECT path, signal_name, {_REFUSED} AS reason FROM v_raw) WHERE reason <> ''"),
    ),
    "file_admission": (
        q_file_admission,
        oracle(
            """SELECT path, file_bytes, file_bytes >= 1024 AND file_bytes <= 10737418240 AS admitted,
            CASE WHEN file_bytes < 1024 THEN 'too small' WHEN file_bytes > 10737418240 THEN 'too large' ELSE '' END
            AS reason FROM v_files"""
        ),
    ),
    "file_order": (
        q_file_order,
        oracle("SELECT path, file_bytes, row_number() OVER (ORDER BY file_bytes, path) AS ord FROM v_files"),
    ),
    "resume_filter": (
        q_resume_filter,
        oracle(
            """SELECT path, file_bytes FROM v_files
            WHERE path NOT IN (SELECT path FROM v_files WHERE processed)"""
        ),
    ),
    "signal_catalog": (
        q_signal_catalog,
        oracle(
            """SELECT path, signal_name FROM v_raw WHERE signal_name NOT IN ('secondsPastEpoch', 'nanoseconds')
            AND n_objects <= 10000"""
        ),
    ),
    "signal_counts": (
        q_signal_counts,
        oracle(
            """SELECT path, s AS signals, s > 0 AS ok FROM (SELECT path, CAST(sum(CASE WHEN signal_name NOT IN
            ('secondsPastEpoch', 'nanoseconds') AND n_objects <= 10000 THEN 1 ELSE 0 END) AS BIGINT) AS s
            FROM v_raw GROUP BY path)"""
        ),
    ),
    "signal_cap": (
        q_signal_cap,
        oracle(
            """SELECT path, signal_name, price FROM v_raw
            QUALIFY row_number() OVER (PARTITION BY path ORDER BY signal_name, price) <= 2"""
        ),
    ),
    "signals_by": (
        q_signals_by,
        oracle(
            """SELECT path, signal_name, split_part(signal_name, '_', 4) AS attribute FROM v_raw
            WHERE signal_name LIKE 'KLYS!_%' ESCAPE '!' AND path NOT LIKE '%!_P%' ESCAPE '!'"""
        ),
    ),
    "file_metadata_distinct": (
        q_file_metadata,
        oracle(
            f"""SELECT path, split_part(stem, '_', 1) AS origin, split_part(stem, '_', 2) AS pathway,
            split_part(stem, '_', 3) AS date, split_part(stem, '_', 4) AS time,
            CASE WHEN split_part(stem, '_', 5) = '' THEN 'default' ELSE split_part(stem, '_', 5) END AS project,
            CAST(substr(split_part(stem, '_', 4), 1, 2) AS INT) < 24
              AND CAST(substr(split_part(stem, '_', 4), 3, 2) AS INT) < 60
              AND CAST(substr(split_part(stem, '_', 4), 5, 2) AS INT) < 60 AS valid, signals
            FROM (SELECT path, {_PARSED}, CAST(sum(CASE WHEN signal_name = 'secondsPastEpoch' THEN 0 ELSE 1 END)
              AS BIGINT) AS signals FROM v_raw GROUP BY path)"""
        ),
    ),
    "archive_json": (
        q_archive_json,
        oracle(
            """SELECT pv, sec::BIGINT * 1000000000 + 5 AS ts_ns, val, val IS NULL AS nan, severity, status, '' AS error
            FROM (SELECT pv, user_id, unnest([1700000000, 1700000060, 1700000121]) AS sec,
              unnest([CAST(user_id AS DOUBLE), NULL, 7.5]) AS val, unnest([0, 1, 3]) AS severity,
              unnest([0, 3, 17]) AS status FROM v_archive_json) WHERE user_id % 7 <> 0"""
        ),
    ),
    "archive_meta": (
        q_archive_meta,
        oracle(
            """SELECT pv, CASE WHEN user_id % 3 = 0 THEN '0=off;1=on' ELSE '' END AS enums,
            'DESC=' || (payload::JSON ->> '$[0].meta.DESC') || ';EGU=' || (payload::JSON ->> '$[0].meta.EGU')
            AS properties, 'probe' AS description FROM v_archive_json"""
        ),
    ),
    "archive_attributes": (
        q_archive_attributes,
        oracle(
            """SELECT pv, 'data_source=archiver;device=IOC;device_area=LI23;device_attribute=TEMP;device_location='
            || CAST(user_id AS VARCHAR) || ';epics_desc=probe;epics_description=probe;epics_egu=C'
            || CASE WHEN user_id % 3 = 0 THEN ';epics_enum_0=off;epics_enum_1=on' ELSE '' END
            || ';origin=ARCHIVER;project=epics_archive;signal_type='
            || CASE WHEN user_id % 3 = 0 THEN 'enum' ELSE 'control' END || ';units=C' AS attributes
            FROM v_archive_json"""
        ),
    ),
    "archive_attach_meta": (
        q_archive_attach_meta,
        oracle(
            """SELECT how, pv, sec::BIGINT * 1000000000 + 5 AS ts_ns, severity, 'C' AS egu,
            CASE WHEN user_id % 3 = 0 THEN 2 ELSE 0 END AS n_enums FROM (SELECT pv, user_id,
            unnest([1700000000, 1700000060, 1700000121]) AS sec, unnest([0, 1, 3]) AS severity FROM v_archive_json)
            CROSS JOIN (VALUES ('own'), ('name')) AS h(how) WHERE user_id % 7 <> 0"""
        ),
    ),
    "archive_requests": (
        q_archive_requests,
        oracle(
            """SELECT pv, 1700000000000000005 AS start_ns, 60500000000 AS period_ns, 3 AS n, CAST(user_id AS DOUBLE) AS total,
            'archiver_data,epics_data,device_IOC,project_epics_archive' || CASE WHEN user_id % 3 = 0 THEN ',has_enums' ELSE '' END
              || ',has_alarms' AS tags, 'C' AS epics_egu, '1' AS data_valid_count, '2' AS data_alarm_count,
            CASE WHEN user_id % 3 = 0 THEN 'true' ELSE 'false' END AS has_enums,
            CASE WHEN user_id % 3 = 0 THEN 'enum' ELSE 'control' END AS signal_type
            FROM v_archive_json WHERE user_id % 7 <> 0"""
        ),
    ),
    "dim_tables": (
        q_dim_tables,
        """WITH s AS (SELECT *, CAST(s_suppkey AS VARCHAR) AS k FROM supplier)
        SELECT 'area' AS dim, 'A' || k AS k, 'N' || s_nationkey || ',B' || (s_suppkey % 4) AS a,
            CAST(s_suppkey + 10 AS DOUBLE) AS b FROM s
        UNION ALL SELECT 'area_sector', 'A' || k, 'S' || (s_suppkey % 7), NULL FROM s
        UNION ALL SELECT 'area_sector', 'A' || k, 'S' || (s_suppkey % 5), NULL FROM s WHERE s_suppkey % 3 = 0
        UNION ALL SELECT 'area_device', 'A' || k, 'D1', s_suppkey + 1 FROM s
        UNION ALL SELECT 'beam_path', 'P' || k, 'A' || k, 0 FROM s
        UNION ALL SELECT 'beam_path', 'P' || k, 'A0', 1 FROM s
        UNION ALL SELECT 'parent_area', 'Q' || k, 'A' || k, 1 FROM s
        UNION ALL SELECT 'sector', 'S' || k, 'sec', s_suppkey FROM s""",
    ),
    "write_buckets": (
        q_write_buckets,
        oracle(
            """SELECT bucket_id, provider_id, request_id, first_ns, last_ns, sample_count, period_ns,
            strftime(make_timestamp(first_ns // 1000), '%Y-%m-%d') AS day, round(value_sum, 4) AS value_sum
            FROM v_clock_buckets WHERE sample_count = 4"""
        ),
    ),
}
