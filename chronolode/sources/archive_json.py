"""Archiver answers: ``[{"meta": {...}, "data": [{...}, ...]}]`` as text, one answer per row.

An answer is parsed once, to a VARIANT, from which points, metadata and errors are taken.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolode.operators.axis import computed
from chronolode.schema import NS_PER_SEC

_NUMBER_TYPES = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)"
_POINT = "struct<secs: bigint, nanos: bigint, val: variant, severity: int, status: int, fields: map<string,string>>"


def _point(p: Column) -> Column:
    secs, nanos = F.coalesce(p["secs"], F.lit(0)), F.coalesce(p["nanos"], F.lit(0))
    is_number = F.schema_of_variant(p["val"]).rlike(_NUMBER_TYPES)
    number = F.when(p["val"].isNull(), F.lit(0.0)).when(is_number, F.try_variant_get(p["val"], "$", "double"))
    return F.struct(
        secs.alias("secs"),
        nanos.alias("nanos"),
        (secs * F.lit(NS_PER_SEC) + nanos).alias("ts_ns"),
        F.coalesce(number, F.lit(float("nan"))).alias("val"),
        F.coalesce(p["severity"], F.lit(0)).alias("severity"),
        F.coalesce(p["status"], F.lit(0)).alias("status"),
        p["fields"].alias("fields"),
    )


def parse_answers(answers: DataFrame, column: str = "payload") -> DataFrame:
    """``pv, error, points, meta``: each answer as one row with its points packed, and ``meta`` as a map of texts.

    Only the first element of an answer counts. A value that is not a JSON
    number becomes NaN, a missing one 0. Text that is no usable array has ``error`` and no points.
    """
    first = F.try_variant_get("__answer", "$[0]", "map<string,variant>")
    parsed = computed(answers.select(column), __answer=F.try_parse_json(F.col(column)))
    parsed = computed(parsed, __first=first)
    parsed = computed(parsed, meta=F.try_variant_get(F.col("__first")["meta"], "$", "map<string,string>"))
    points = F.try_variant_get(F.col("__first")["data"], "$", f"array<{_POINT}>")
    return parsed.select(
        F.col("meta")["name"].alias("pv"),
        F.when(F.col("__answer").isNull(), F.lit("answer is no JSON"))
        .when(F.col("__first").isNull(), F.lit("answer has no signal: a list with one entry at least is needed"))
        .otherwise(F.lit(""))
        .alias("error"),
        F.transform(points, _point).alias("points"),
        "meta",
    )


def described(answers: DataFrame) -> DataFrame:
    """``meta`` of parsed answers taken apart into ``enums``, ``properties`` and ``description``."""
    meta = F.col("meta")
    enums = F.transform_keys(F.map_filter(meta, lambda k, _: k.startswith("ENUM_")), lambda k, _: F.substring(k, 6, 1 << 20))
    parts = {
        "enums": enums,
        "properties": F.map_filter(meta, lambda k, _: ~k.startswith("ENUM_") & (k != "name")),
        "description": F.coalesce(meta["DESC"], F.lit("")),
    }
    return answers.withColumns(parts).drop("meta")


def archive_json(answers: DataFrame, column: str = "payload", meta: bool = False) -> DataFrame:
    """``pv, secs, nanos, ts_ns, val, severity, status, fields, error``, one row per point.

    An answer in error gives one row without a point; one without points gives no row. With ``meta`` every row also has
    ``enums``, ``properties`` and ``description`` of its own answer, without a join.
    """
    parsed = parse_answers(answers, column)
    more = ["enums", "properties", "description"] if meta else []
    if meta:
        parsed = described(parsed)
    rows = parsed.select("pv", "error", *more, F.explode_outer("points").alias("p"))
    # tested on the exploded row: a test on the packed points would make them once more
    return rows.where((F.col("error") != "") | F.col("p").isNotNull()).select("pv", "p.*", "error", *more)


def archive_meta(answers: DataFrame, column: str = "payload") -> DataFrame:
    """``pv, enums, properties, description`` of each usable answer."""
    return described(parse_answers(answers, column).where("meta IS NOT NULL").select("pv", "meta"))
