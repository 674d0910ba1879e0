"""Enrichment with device and location dictionaries."""

from pyspark.sql import functions as F

from chronolode.functions.names import infer_units
from chronolode.operators import spatial
from chronolode.queries import views as v
from chronolode.queries.views import oracle


def _parsed(spark, sf):
    return spatial.spatial_parse(v.v_samples(spark, sf).select("pv").distinct(), "_")


def q_classify(spark, sf):
    out = spatial.spatial_classify(_parsed(spark, sf), v.v_dims(spark, sf)["device"])
    return out.select("pv", "category", "function", "controllable", F.array_join("device_tags", ",").alias("tags"))


def q_signal(spark, sf):
    out = spatial.spatial_signal(_parsed(spark, sf), v.v_dims(spark, sf).get("pattern_tags"))
    return out.select("pv", "signal_type", "units", F.array_join("pattern_tags", ",").alias("tags"))


def q_position(spark, sf):
    out = spatial.spatial_position(_parsed(spark, sf), v.v_dims(spark, sf)["area"])
    return out.select(
        "pv", F.round("z", 6).alias("z"), F.round("z_unc", 6).alias("z_unc"), F.array_join("beam_paths", ",").alias("beam_path"),
        "area_description",
    )


def q_tags(spark, sf):
    pvs = v.v_samples(spark, sf).select("pv").distinct()
    out = spatial.spatial_metadata(pvs, v.v_dims(spark, sf), "_")
    return out.select("pv", F.array_join("tags", ",").alias("tags"))


def q_enrich(spark, sf):
    samples = v.v_samples(spark, sf).select("event_id", "pv")
    out = spatial.spatial_enrich(samples, v.v_dims(spark, sf), "_")
    return out.select("event_id", "pv", "valid", "category", "signal_type", F.round("z", 6).alias("z"),
                      F.array_join("tags", ",").alias("tags"))


def q_bucket_attributes(spark, sf):
    pvs = v.v_samples(spark, sf).select("pv").distinct()
    meta = spatial.spatial_metadata(pvs, v.v_dims(spark, sf), "_")
    out = spatial.bucket_attributes(meta, F.lit("default"), F.lit("CU"), infer_units(F.col("attribute")))
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda p: F.concat(p["key"], F.lit("="), p["value"]))
    return out.select("pv", F.array_join(pairs, ";").alias("attributes"), F.array_join("tags", ",").alias("tags"))


_PARTS = """SELECT pv, p[1] AS dev, p[2] AS area, p[3] AS position, array_to_string(p[4:], '_') AS attr
    FROM (SELECT pv, string_split(pv, '_') AS p FROM (SELECT DISTINCT pv FROM v_samples))"""
_PATTERN = """CASE dev WHEN 'BPMS' THEN ['beam_position', 'diagnostic', 'monitor']
    WHEN 'KLYS' THEN ['klystron', 'rf_power', 'actuator'] WHEN 'QUAD' THEN ['quadrupole', 'magnetic', 'focusing']
    WHEN 'BEND' THEN ['dipole', 'magnetic', 'steering'] WHEN 'TMIT' THEN ['charge', 'diagnostic', 'monitor']
    ELSE [] END"""
_KIND = """CASE WHEN contains(attr, 'AMPL') THEN 'amplitude' WHEN contains(attr, 'PHAS') THEN 'phase'
    WHEN contains(attr, 'TMIT') THEN 'charge' WHEN contains(attr, 'BCTRL') THEN 'control' ELSE '' END"""
_UNIT = """CASE WHEN contains(attr, 'AMPL') THEN 'MV' WHEN contains(attr, 'PHAS') THEN 'degrees'
    WHEN contains(attr, 'TMIT') THEN 'pC' WHEN contains(attr, 'BCTRL') THEN 'A' ELSE '' END"""
_NUM = "TRY_CAST(position AS DOUBLE)"
_Z = f"""CASE WHEN z_min IS NULL THEN 0.0::DOUBLE WHEN {_NUM} IS NULL THEN (z_min + z_max) / 2
    ELSE z_min + {_NUM} / 1000 * (z_max - z_min) END"""
_ZU = f"""CASE WHEN z_min IS NULL THEN 1.0::DOUBLE WHEN {_NUM} IS NULL THEN (z_max - z_min) / 2 ELSE 0.1::DOUBLE END"""
_ALL = f"""WITH parts AS ({_PARTS}), meta AS (SELECT parts.*, coalesce(d.category, '') AS category,
    coalesce(d.controllable, false) AS controllable, {_KIND} AS kind, {_UNIT} AS units, {_Z} AS z, {_ZU} AS z_unc,
    a.beam_path AS beam_path, array_to_string(list_sort(list_distinct(list_concat(
      CASE WHEN d.category IS NULL THEN [] ELSE ['kind_' || d.category] END, {_PATTERN},
      ['area_' || parts.area, 'device_' || dev], CASE WHEN {_KIND} = '' THEN [] ELSE ['signal_' || {_KIND}] END,
      CASE WHEN a.beam_path IS NULL THEN [] ELSE ['beampath_' || a.beam_path] END))), ',') AS tags
    FROM parts LEFT JOIN v_dim_device d ON d.device = dev LEFT JOIN v_dim_area a ON a.area = parts.area)"""


QUERIES = {
    "spatial_classify": (
        q_classify,
        oracle(
            f"""SELECT pv, coalesce(category, '') AS category, coalesce('does ' || category, '') AS function,
            coalesce(controllable, false) AS controllable, coalesce('kind_' || category, '') AS tags
            FROM ({_PARTS}) LEFT JOIN v_dim_device d ON d.device = dev"""
        ),
    ),
    "spatial_signal": (
        q_signal,
        oracle(f"SELECT pv, {_KIND} AS signal_type, {_UNIT} AS units, array_to_string({_PATTERN}, ',') AS tags FROM ({_PARTS})"),
    ),
    "spatial_position": (
        q_position,
        oracle(
            f"""SELECT pv, round({_Z}, 6) AS z, round({_ZU}, 6) AS z_unc, coalesce(beam_path, '') AS beam_path,
            coalesce('area ' || a.area, '') AS area_description
            FROM ({_PARTS}) p LEFT JOIN v_dim_area a ON a.area = p.area"""
        ),
    ),
    "spatial_tags": (q_tags, oracle(_ALL + " SELECT pv, tags FROM meta")),
    "spatial_enrich": (
        q_enrich,
        oracle(
            _ALL
            + """ SELECT s.event_id, pv, true AS valid, category, kind AS signal_type, round(z, 6) AS z, tags
            FROM v_samples s JOIN meta USING (pv)"""
        ),
    ),
    "bucket_attributes": (
        q_bucket_attributes,
        oracle(
            _ALL
            + """ SELECT pv, 'device=' || dev || ';device_area=' || area || ';device_attribute=' || attr
            || ';device_location=' || position || ';origin=CU;project=default;spatial_area=' || area
            || ';spatial_category=' || category || ';spatial_controllable=' || CAST(controllable AS VARCHAR)
            || ';spatial_device_type=' || dev || ';spatial_function=' || CASE category WHEN '' THEN ''
              ELSE 'does ' || category END
            || ';spatial_position=' || position || ';spatial_signal_type=' || kind
            || ';spatial_z_position=' || printf('%.6f', z) || ';spatial_z_uncertainty=' || printf('%.6f', z_unc)
            || ';units=' || CASE WHEN attr = 'X' THEN 'mm' WHEN attr = 'TMITBR' THEN 'pC' WHEN attr = 'BCTRL' THEN 'kG'
              WHEN contains(attr, 'PHAS') THEN 'deg' ELSE 'MV/m' END AS attributes,
            'h5_data,device_' || dev || ',project_default,spatial_enriched'
            || CASE category WHEN '' THEN '' ELSE ',spatial_' || category END
            || CASE kind WHEN '' THEN '' ELSE ',spatial_' || kind END
            || ',spatial_' || lower(area) || CASE WHEN controllable THEN ',spatial_controllable' ELSE '' END AS tags
            FROM meta"""
        ),
    ),
}
