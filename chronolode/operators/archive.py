"""Archiver points with their metadata."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolode.functions.archive import archive_signal_type
from chronolode.functions.names import parse_pv_colon
from chronolode.functions.values import attr_to_map, map_to_attr


def archive_attach_meta(points: DataFrame, meta: DataFrame) -> DataFrame:
    """Points with the metadata of their own signal, matched by name."""
    return points.join(one_meta(meta), "pv", "left")


def one_meta(meta: DataFrame) -> DataFrame:
    """One metadata row per signal, always the same one, however many answers name it."""
    whole = F.struct("enums", "properties", "description")
    return meta.groupBy("pv").agg(F.max_by(whole, F.to_json(whole)).alias("__m")).select("pv", "__m.*")


def archive_attributes(
    meta: DataFrame, origin: str = "ARCHIVER", project: str = "epics_archive", source: str = "archiver"
) -> DataFrame:
    """Add ``attributes`` of the ingest request made from one archived signal."""
    info = meta.withColumn("__i", parse_pv_colon(F.col("pv"))).withColumn(
        "__kind", archive_signal_type(F.col("__i.device"), F.col("enums"))
    )
    core = {
        "device": F.col("__i.device"),
        "device_area": F.col("__i.area"),
        "device_location": F.col("__i.location"),
        "device_attribute": F.col("__i.attribute"),
        "signal_type": F.col("__kind"),
        "units": F.coalesce(F.col("properties")["EGU"], F.lit("")),
        "origin": F.lit(origin),
        "project": F.lit(project),
        "data_source": F.lit(source),
    }

    def pair(key, value):
        return F.struct(key.alias("key"), value.alias("value"))

    def renamed(column, name):
        return F.transform(map_to_attr(F.col(column)), lambda p: pair(name(p["key"]), p["value"]))

    described = F.when(
        F.coalesce("description", F.lit("")) != "", F.array(pair(F.lit("epics_description"), F.col("description")))
    ).otherwise(F.array().cast("array<struct<key:string,value:string>>"))
    pairs = F.concat(
        F.array(*[pair(F.lit(k), v) for k, v in core.items()]),
        renamed("properties", lambda k: F.lower(F.concat(F.lit("epics_"), k))),
        renamed("enums", lambda k: F.concat(F.lit("epics_enum_"), k)),
        described,
    )
    return info.withColumn("attributes", attr_to_map(pairs)).drop("__i", "__kind")
