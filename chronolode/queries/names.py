"""Names of files and signals, archiver codes."""

from pyspark.sql import functions as F

from chronolode.functions import archive, names
from chronolode.functions.timestamps import file_timestamp
from chronolode.queries import views as v
from chronolode.queries.views import oracle


def q_parse_file_strict(spark, sf):
    return v.v_files(spark, sf).select("path", names.parse_file_strict(F.col("path")).alias("f")).select("path", "f.*")


def q_file_timestamp(spark, sf):
    stem = names.file_stem(F.col("path"))
    return v.v_files(spark, sf).select(
        "path", file_timestamp(F.split_part(stem, F.lit("_"), F.lit(3)), F.split_part(stem, F.lit("_"), F.lit(4))).alias("epoch")
    )


def q_parse_file_lenient(spark, sf):
    return v.v_files(spark, sf).select("path", names.parse_file_lenient(F.col("path")).alias("f")).select("path", "f.*")


def _pv_query(parse, view=v.v_samples):
    def run(spark, sf):
        pvs = view(spark, sf).select("pv").distinct()
        return pvs.select("pv", parse(F.col("pv")).alias("p")).select("pv", "p.*")

    return run


def q_infer_units(spark, sf):
    return v.v_samples(spark, sf).select(
        "event_id", names.infer_units(names.parse_pv_strict(F.col("pv"))["attribute"]).alias("units")
    )


def q_infer_signal_type(spark, sf):
    return v.v_samples(spark, sf).select(
        "event_id", names.infer_signal_type(names.parse_pv_strict(F.col("pv"))["attribute"]).alias("signal_type")
    )


def q_archive_signal_type(spark, sf):
    from chronolode.sources.archive_json import archive_meta

    meta = archive_meta(v.v_archive_json(spark, sf))
    device = names.parse_pv_colon(F.col("pv"))["device"]
    return meta.select(
        "pv",
        archive.archive_signal_type(device, F.col("enums")).alias("signal_type"),
        F.coalesce(F.col("properties")["EGU"], F.lit("")).alias("units"),
    )


def q_severity_name(spark, sf):
    return v.v_points(spark, sf).select("event_id", archive.severity_name(F.col("severity")).alias("severity"))


def q_status_name(spark, sf):
    return v.v_points(spark, sf).select("event_id", archive.status_name(F.col("status")).alias("status"))


def q_point_valid(spark, sf):
    return v.v_points(spark, sf).select(
        "event_id", archive.point_valid(F.col("value"), F.col("severity")).alias("valid")
    )


def q_mask_invalid(spark, sf):
    masked = archive.mask_invalid(F.col("value"), F.col("severity"))
    return v.v_points(spark, sf).select("event_id", F.nanvl(masked, F.lit(None)).alias("value"), F.isnan(masked).alias("nan"))


_STEM = r"regexp_extract(path, '([^/]*)\.h5$', 1)"
_STRICT = "'^([A-Z]+)_([A-Z]+)_([0-9]{8})_([0-9]{6})(_([A-Za-z0-9]+))?$'"
_EPOCH = """CASE WHEN {ok} THEN CAST(epoch(make_timestamp(CAST(substr(d, 1, 4) AS BIGINT),
    CAST(substr(d, 5, 2) AS BIGINT), CAST(substr(d, 7, 2) AS BIGINT), CAST(substr(t, 1, 2) AS BIGINT),
    CAST(substr(t, 3, 2) AS BIGINT), CAST(substr(t, 5, 2) AS DOUBLE))) AS BIGINT) ELSE 0 END"""
_EP = _EPOCH.format(ok="ok")
_PV = "(SELECT DISTINCT pv FROM v_samples)"
_SPLIT = r"string_split(pv, '_')"
_PV_OK = r"regexp_full_match(pv, '([A-Z]+)_([A-Z0-9]+)_([0-9]+)_([A-Z0-9_]+)')"
_ATTR = f"CASE WHEN {_PV_OK} THEN array_to_string(({_SPLIT})[4:], '_') ELSE pv END"
_UNITS = """CASE WHEN {a} IN ('X', 'Y', 'Z') THEN 'mm' WHEN {a} IN ('TMIT', 'TMITBR') THEN 'pC'
    WHEN {a} IN ('BCTRL', 'BDES', 'BACT') THEN 'kG' WHEN contains({a}, 'PHAS') THEN 'deg'
    WHEN contains({a}, 'AMPL') THEN 'MV/m' ELSE 'unknown' END"""
_TYPE = """CASE WHEN {a} IN ('X', 'Y', 'Z') THEN 'position' WHEN {a} IN ('TMIT', 'TMITBR') THEN 'charge'
    WHEN {a} IN ('BCTRL', 'BDES') THEN 'control' WHEN {a} = 'BACT' THEN 'actual'
    WHEN contains({a}, 'PHAS') THEN 'phase' WHEN contains({a}, 'AMPL') THEN 'amplitude' ELSE 'measurement' END"""

QUERIES = {
    "parse_file_strict": (
        q_parse_file_strict,
        oracle(
            f"""SELECT path, CASE WHEN ok THEN split_part(stem, '_', 1) ELSE 'unknown' END AS origin,
            CASE WHEN ok THEN split_part(stem, '_', 2) ELSE 'unknown' END AS pathway,
            CASE WHEN ok THEN d ELSE 'unknown' END AS date, CASE WHEN ok THEN t ELSE 'unknown' END AS time,
            CASE WHEN NOT ok THEN 'unknown' WHEN split_part(stem, '_', 5) = '' THEN 'default'
              ELSE split_part(stem, '_', 5) END AS project, {_EP} AS file_ts, ok AS valid
            FROM (SELECT *, split_part(stem, '_', 3) AS d, split_part(stem, '_', 4) AS t,
              regexp_matches(stem, {_STRICT}) AS ok FROM (SELECT path, {_STEM} AS stem FROM v_files))"""
        ),
    ),
    "file_timestamp": (
        q_file_timestamp,
        oracle(
            f"""SELECT path, {_EP} AS epoch FROM (SELECT *, length(d) = 8 AND length(t) = 6 AS ok FROM (SELECT path,
            split_part({_STEM}, '_', 3) AS d, split_part({_STEM}, '_', 4) AS t FROM v_files))"""
        ),
    ),
    "parse_file_lenient": (
        q_parse_file_lenient,
        oracle(
            """SELECT path, CASE WHEN len(p) >= 2 THEN p[1] || '_' || p[2] ELSE p[1] END AS beam_line,
            coalesce(p[3], 'unknown_date') AS date, coalesce(p[4], 'unknown_time') AS time_id, stem || '.h5' AS filename
            FROM (SELECT path, stem, string_split(stem, '_') AS p FROM (SELECT path, replace(replace(path, '/data/', ''),
            '.h5', '') AS stem FROM v_files))"""
        ),
    ),
    "parse_pv_strict": (
        _pv_query(names.parse_pv_strict),
        oracle(
            f"""SELECT pv, CASE WHEN ok THEN split_part(pv, '_', 1) ELSE 'unknown' END AS device,
            CASE WHEN ok THEN split_part(pv, '_', 2) ELSE 'unknown' END AS area,
            CASE WHEN ok THEN split_part(pv, '_', 3) ELSE 'unknown' END AS location, a AS attribute,
            CASE WHEN ok THEN {_UNITS.format(a="a")} ELSE 'unknown' END AS units,
            CASE WHEN ok THEN {_TYPE.format(a="a")} ELSE 'unknown' END AS signal_type
            FROM (SELECT pv, {_PV_OK} AS ok, {_ATTR} AS a FROM {_PV})"""
        ),
    ),
    "parse_pv_split": (
        _pv_query(names.parse_pv_split),
        oracle(
            f"""SELECT pv, p[1] AS device_type, p[2] AS device_area, p[3] AS device_location,
            p[4] AS measurement_type, len(p) >= 3 AS valid FROM (SELECT pv, {_SPLIT} AS p FROM {_PV})"""
        ),
    ),
    "parse_pv_colon": (
        _pv_query(names.parse_pv_colon, lambda s, sf: v.v_samples(s, sf).withColumn("pv", F.expr("replace(pv, '_', ':')"))),
        oracle(
            f"""SELECT replace(pv, '_', ':') AS pv, p[1] AS device, coalesce(p[2], 'UNKNOWN') AS area,
            coalesce(p[3], 'UNKNOWN') AS location, coalesce(p[4], 'UNKNOWN') AS attribute
            FROM (SELECT pv, {_SPLIT} AS p FROM {_PV})"""
        ),
    ),
    "parse_pv_spatial": (
        _pv_query(lambda c: names.parse_pv_spatial(c, "_")),
        oracle(
            f"""SELECT pv, p[1] AS device_type, p[2] AS area, p[3] AS position, array_to_string(p[4:], '_') AS attribute,
            true AS valid FROM (SELECT pv, {_SPLIT} AS p FROM {_PV})"""
        ),
    ),
    "infer_units": (
        q_infer_units,
        oracle(f"SELECT event_id, {_UNITS.format(a='a')} AS units FROM (SELECT event_id, {_ATTR} AS a FROM v_samples)"),
    ),
    "infer_signal_type": (
        q_infer_signal_type,
        oracle(f"SELECT event_id, {_TYPE.format(a='a')} AS signal_type FROM (SELECT event_id, {_ATTR} AS a FROM v_samples)"),
    ),
    "archive_signal_type": (
        q_archive_signal_type,
        oracle(
            """SELECT pv, CASE WHEN user_id % 3 = 0 THEN 'enum' ELSE 'control' END AS signal_type,
            payload::JSON ->> '$[0].meta.EGU' AS units FROM v_archive_json"""
        ),
    ),
    "severity_name": (
        q_severity_name,
        oracle(
            """SELECT event_id, CASE severity WHEN 0 THEN 'NO_ALARM' WHEN 1 THEN 'MINOR' WHEN 2 THEN 'MAJOR'
            WHEN 3 THEN 'INVALID' ELSE 'UNKNOWN' END AS severity FROM v_points"""
        ),
    ),
    "status_name": (
        q_status_name,
        oracle(
            """SELECT event_id, coalesce(['NO_ALARM', 'READ', 'WRITE', 'HIHI', 'HIGH', 'LOLO', 'LOW', 'STATE', 'COS',
            'COMM', 'TIMEOUT', 'HWLIMIT', 'CALC', 'SCAN', 'LINK', 'SOFT', 'BAD_SUB', 'UDF', 'DISABLE', 'SIMM',
            'READ_ACCESS', 'WRITE_ACCESS'][status + 1], 'UNKNOWN') AS status FROM v_points"""
        ),
    ),
    "point_valid": (
        q_point_valid,
        oracle("SELECT event_id, isfinite(value) AND severity < 3 AS valid FROM v_points"),
    ),
    "mask_invalid": (
        q_mask_invalid,
        oracle(
            """SELECT event_id, CASE WHEN isfinite(value) AND severity < 3 THEN value END AS value,
            NOT (isfinite(value) AND severity < 3) AS nan FROM v_points"""
        ),
    ),
}
