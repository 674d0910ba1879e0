"""Enrichment of signals with device, signal and location knowledge.

The dictionaries are joined without hints: they are small in practice, and
Spark measures them before it broadcasts.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolode.functions.names import parse_pv_spatial

# Tags of the built-in device and attribute patterns.
PATTERN_TAGS = {
    "BPMS": ["beam_position", "diagnostic", "monitor"],
    "KLYS": ["klystron", "rf_power", "actuator"],
    "QUAD": ["quadrupole", "magnetic", "focusing"],
    "BEND": ["dipole", "magnetic", "steering"],
    "TMIT": ["charge", "diagnostic", "monitor"],
    "AMPL": ["amplitude", "rf", "measurement"],
    "PHAS": ["phase", "rf", "measurement"],
    "BCTRL": ["control", "magnetic", "actuator"],
}
# Attribute word, signal type, units; the first word found decides.
SIGNAL_RULES = [
    ("AMPL", "amplitude", "MV"),
    ("PHAS", "phase", "degrees"),
    ("TMIT", "charge", "pC"),
    ("BCTRL", "control", "A"),
]
Z_UNCERTAINTY = 0.1
UNKNOWN_Z = (0.0, 1.0)

_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
_NO_TAGS = "array<string>"


def pattern_tags(spark: SparkSession) -> DataFrame:
    """``device_type, pattern_tags``: the built-in patterns as a dimension."""
    return spark.createDataFrame(list(PATTERN_TAGS.items()), "device_type string, pattern_tags array<string>")


def _no_tags() -> Column:
    return F.array().cast(_NO_TAGS)


def spatial_parse(df: DataFrame, sep: str = ":") -> DataFrame:
    """Add device_type, area, position, attribute and valid."""
    return df.withColumn("__p", parse_pv_spatial(F.col("pv"), sep)).select("*", "__p.*").drop("__p")


def spatial_classify(df: DataFrame, dim_device: DataFrame) -> DataFrame:
    """Add category, function, controllable and device_tags by device type."""
    dim = dim_device.select("device_type", "category", "function", "controllable", F.col("tags").alias("device_tags"))
    return df.join(dim, "device_type", "left").withColumns(
        {
            "category": F.coalesce("category", F.lit("")),
            "function": F.coalesce("function", F.lit("")),
            "controllable": F.coalesce("controllable", F.lit(False)),
            "device_tags": F.coalesce("device_tags", _no_tags()),
        }
    )


def _with_pattern_tags(df: DataFrame, dim: DataFrame | None) -> DataFrame:
    """Add pattern_tags by device type, from a dimension or, where none is given, from the built-in patterns."""
    if dim is not None:
        return df.join(dim, "device_type", "left")
    pairs = [x for name, tags in PATTERN_TAGS.items() for x in (F.lit(name), F.array(*map(F.lit, tags)))]
    return df.withColumn("pattern_tags", F.create_map(*pairs)[F.col("device_type")])


def spatial_signal(df: DataFrame, dim_pattern_tags: DataFrame | None = None) -> DataFrame:
    """Add signal_type and units by attribute, and pattern_tags by device type."""
    kind, units = F.lit(""), F.lit("")
    for word, name, unit in reversed(SIGNAL_RULES):
        has = F.col("attribute").contains(word)
        kind, units = F.when(has, F.lit(name)).otherwise(kind), F.when(has, F.lit(unit)).otherwise(units)
    return (
        _with_pattern_tags(df, dim_pattern_tags)
        .withColumn("pattern_tags", F.coalesce("pattern_tags", _no_tags()))
        .withColumn("signal_type", kind)
        .withColumn("units", units)
    )


def spatial_position(df: DataFrame, dim_area: DataFrame) -> DataFrame:
    """Add z, z_unc, beam_paths and area_description by area and position."""
    dim = dim_area.select(
        "area", "z_min", "z_max", F.col("beam_path").alias("beam_paths"), F.col("description").alias("area_description")
    )
    span = F.col("z_max") - F.col("z_min")
    offset = F.regexp_extract("position", _NUMBER, 1).try_cast("double")
    unknown = F.col("z_min").isNull() | F.col("z_max").isNull()
    z = (
        F.when(unknown, UNKNOWN_Z[0])
        .when(offset.isNull(), (F.col("z_min") + F.col("z_max")) / 2)
        .otherwise(F.col("z_min") + offset / 1000 * span)
    )
    unc = F.when(unknown, UNKNOWN_Z[1]).when(offset.isNull(), span / 2).otherwise(Z_UNCERTAINTY)
    return (
        df.join(dim, "area", "left")
        .withColumn("z", z)
        .withColumn("z_unc", unc)
        .withColumn("beam_paths", F.coalesce("beam_paths", _no_tags()))
        .withColumn("area_description", F.coalesce("area_description", F.lit("")))
        .drop("z_min", "z_max")
    )


def spatial_tags(df: DataFrame) -> DataFrame:
    """Add ``tags``: device and pattern tags plus those made of the parts, sorted, each once."""

    def made(prefix, part):
        return F.when(F.col(part) != "", F.concat(F.lit(prefix), F.col(part)))

    parts = F.array_compact(
        F.array(made("area_", "area"), made("device_", "device_type"), made("signal_", "signal_type"))
    )
    paths = F.transform(F.filter("beam_paths", lambda p: p != ""), lambda p: F.concat(F.lit("beampath_"), p))
    return df.withColumn("tags", F.array_sort(F.array_distinct(F.concat("device_tags", "pattern_tags", parts, paths))))


SPATIAL_COLUMNS = [
    "device_type", "area", "position", "attribute", "valid", "category", "function", "controllable",
    "signal_type", "units", "z", "z_unc", "beam_paths", "area_description", "tags",
]


def spatial_metadata(pvs: DataFrame, dims: dict[str, DataFrame], sep: str = ":") -> DataFrame:
    """``pv`` and all spatial columns, one row per row of ``pvs``."""
    out = spatial_parse(pvs.select("pv"), sep)
    out = spatial_classify(out, dims["device"])
    out = spatial_signal(out, dims.get("pattern_tags"))
    out = spatial_position(out, dims["area"])
    out = spatial_tags(out)
    return out.select("pv", *SPATIAL_COLUMNS)


def spatial_enrich(df: DataFrame, dims: dict[str, DataFrame], sep: str = ":") -> DataFrame:
    """``df`` with its spatial columns.

    A name says all that is looked up by it, so every row is read where it is
    and meets only the dictionaries; no row is shuffled by its signal.
    """
    out = spatial_parse(df, sep)
    for step, dim in ((spatial_classify, "device"), (spatial_signal, "pattern_tags"), (spatial_position, "area")):
        out = step(out, dims.get(dim))
    return spatial_tags(out).select(*df.columns, *SPATIAL_COLUMNS)


def bucket_attributes(df: DataFrame, project: Column, origin: Column, file_units: Column) -> DataFrame:
    """Add the document ``attributes`` and ``tags`` of an enriched bucket row."""
    names = {
        "device": F.col("device_type"),
        "device_area": F.col("area"),
        "device_location": F.col("position"),
        "device_attribute": F.col("attribute"),
        "spatial_area": F.col("area"),
        "spatial_category": F.col("category"),
        "spatial_controllable": F.col("controllable").cast("string"),
        "spatial_device_type": F.col("device_type"),
        "spatial_function": F.col("function"),
        "spatial_position": F.col("position"),
        "spatial_signal_type": F.col("signal_type"),
        "spatial_z_position": F.format_string("%.6f", "z"),
        "spatial_z_uncertainty": F.format_string("%.6f", "z_unc"),
        "origin": origin,
        "project": project,
        "units": file_units,
    }
    attributes = F.map_from_arrays(
        F.array(*[F.lit(k) for k in names]), F.array(*[F.coalesce(v, F.lit("")) for v in names.values()])
    )

    def spatial(part):
        return F.when(F.col(part) != "", F.concat(F.lit("spatial_"), F.lower(part)))

    tags = F.array_compact(
        F.array(
            F.lit("h5_data"),
            F.concat(F.lit("device_"), F.col("device_type")),
            F.concat(F.lit("project_"), project),
            F.when(F.col("valid"), F.lit("spatial_enriched")),
            spatial("category"),
            spatial("signal_type"),
            spatial("area"),
            F.when(F.col("controllable"), F.lit("spatial_controllable")),
        )
    )
    return df.withColumn("attributes", attributes).withColumn("tags", tags)
