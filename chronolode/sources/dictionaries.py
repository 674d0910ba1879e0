"""Beamline and device dictionaries: JSON documents flattened into dimension tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolode.operators.spatial import pattern_tags

_BEAMLINE = """struct<
  areas: map<string, struct<beam_path: array<string>, description: string, z_range: array<double>, sector: string,
    beam_system: string, function: string,
    devices: map<string, struct<z_position: double, z_uncertainty: double>>>>,
  beam_paths: map<string, struct<description: string, sequence: array<string>, beam_system: string,
    origin: string, destination: string>>,
  parent_areas: map<string, struct<description: string, children: array<string>, z_range: array<double>>>,
  sectors: map<string, struct<z_range: array<double>, description: string>>>"""
_DEVICES = "map<string, struct<category: string, function: string, controllable: boolean, tags: array<string>>>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc``: each JSON file below ``path`` whole."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))


def dim_tables(beamline: DataFrame, devices: DataFrame | None = None) -> dict[str, DataFrame]:
    """Dimension tables from JSON text in column ``doc``.

    area, area_sector, area_device, beam_path, parent_area and sector come from
    the beamline documents, device from the device documents, pattern_tags is
    built in. A sector may be one name or a list of them.
    """
    doc = beamline.select(F.from_json("doc", _BEAMLINE).alias("d"))
    areas = doc.select(F.explode("d.areas").alias("area", "a"))
    sector = F.col("a.sector")
    sectors = F.coalesce(F.from_json(sector, "array<string>"), F.array(sector))
    tables = {
        "area": areas.select(
            "area",
            F.get("a.z_range", 0).alias("z_min"),
            F.get("a.z_range", 1).alias("z_max"),
            F.col("a.beam_path").alias("beam_path"),
            "a.description",
            "a.beam_system",
            "a.function",
        ),
        "area_sector": areas.where(sector.isNotNull()).select("area", F.explode(sectors).alias("sector")),
        "area_device": areas.select("area", F.explode("a.devices").alias("location", "v")).select(
            "area", "location", "v.z_position", "v.z_uncertainty"
        ),
        "beam_path": doc.select(F.explode("d.beam_paths").alias("beam_path", "p")).select(
            "beam_path",
            "p.description",
            "p.beam_system",
            "p.origin",
            "p.destination",
            F.posexplode("p.sequence").alias("position", "area"),
        ),
        "parent_area": doc.select(F.explode("d.parent_areas").alias("parent", "p")).select(
            "parent",
            "p.description",
            F.get("p.z_range", 0).alias("z_min"),
            F.get("p.z_range", 1).alias("z_max"),
            F.posexplode("p.children").alias("position", "child"),
        ),
        "sector": doc.select(F.explode("d.sectors").alias("sector", "s")).select(
            "sector", F.get("s.z_range", 0).alias("z_min"), F.get("s.z_range", 1).alias("z_max"), "s.description"
        ),
        "pattern_tags": pattern_tags(beamline.sparkSession),
    }
    if devices is not None:
        entries = devices.select(F.explode(F.from_json("doc", _DEVICES)).alias("device_type", "v"))
        tables["device"] = entries.select("device_type", "v.*")
    return tables
