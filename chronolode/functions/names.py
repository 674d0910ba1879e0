"""Column functions that read file names and signal names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronolode.functions.timestamps import civil_seconds

FILE_NAME = r"^([A-Z]+)_([A-Z]+)_(\d{8})_(\d{6})(?:_([A-Za-z0-9]+))?$"
SIGNAL_NAME = r"^([A-Z]+)_([A-Z0-9]+)_(\d+)_([A-Z0-9_]+)$"

# Rules tried in order; "=" compares the attribute, "~" searches in it.
# (rule, words, units, signal type)
ATTRIBUTE_RULES = [
    ("=", ("X", "Y", "Z"), "mm", "position"),
    ("=", ("TMIT", "TMITBR"), "pC", "charge"),
    ("=", ("BCTRL", "BDES"), "kG", "control"),
    ("=", ("BACT",), "kG", "actual"),
    ("~", ("PHAS",), "deg", "phase"),
    ("~", ("AMPL",), "MV/m", "amplitude"),
    ("~", ("POW",), "MW", "power"),
    ("~", ("TEMP",), "°C", "temperature"),
    ("~", ("PRESS",), "Torr", "pressure"),
    ("~", ("CURR",), "A", "current"),
    ("~", ("VOLT",), "V", "voltage"),
]


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def split_plain(text: Column, sep: str) -> Column:
    """Parts between separators; an empty last part does not count."""
    parts = F.split(text, "[" + sep + "]")
    last_empty = F.element_at(parts, -1) == ""
    return F.when(last_empty, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def file_parts(path: Column) -> Column:
    """Parts of the file name ORIGIN_PATHWAY_DATE_TIME[_project], none of which holds an underscore; NULL for other names."""
    stem = file_stem(path)
    return F.when(stem.rlike(FILE_NAME), F.split(stem, "_"))


def parse_file_strict(path: Column, tz: str = "UTC") -> Column:
    """``struct<origin, pathway, date, time, project, file_ts, valid>`` of ORIGIN_PATHWAY_DATE_TIME[_project]."""
    return file_of_parts(file_parts(path), tz)


def file_of_parts(parts: Column, tz: str = "UTC") -> Column:
    """The struct of ``parse_file_strict`` from the parts of a file name."""
    date, time = F.get(parts, 2), F.get(parts, 3).substr(1, 6)  # a line break may follow the match

    def known(part):
        return F.coalesce(part, F.lit("unknown"))

    def number(text, at, n=2):
        return text.substr(at, n).try_cast("int")

    project = F.coalesce(F.regexp_extract(F.get(parts, 4), "^[A-Za-z0-9]*", 0), F.lit("default"))
    clock = (number(time, i) for i in (1, 3, 5))
    ts = F.coalesce(civil_seconds(number(date, 1, 4), number(date, 5), number(date, 7), *clock, tz), F.lit(0).cast("bigint"))
    return F.struct(
        known(F.get(parts, 0)).alias("origin"),
        known(F.get(parts, 1)).alias("pathway"),
        known(date).alias("date"),
        known(time).alias("time"),
        F.when(parts.isNull(), "unknown").otherwise(project).alias("project"),
        ts.alias("file_ts"),
        (ts > 0).alias("valid"),
    )


def parse_file_lenient(path: Column) -> Column:
    """``struct<beam_line, date, time_id, filename>`` from whatever parts there are."""
    parts = split_plain(file_stem(path), "_")
    first, second = F.get(parts, 0), F.get(parts, 1)
    return F.struct(
        F.coalesce(F.concat(first, F.lit("_"), second), first, F.lit("unknown_beamline")).alias("beam_line"),
        F.coalesce(F.get(parts, 2), F.lit("unknown_date")).alias("date"),
        F.coalesce(F.get(parts, 3), F.lit("unknown_time")).alias("time_id"),
        file_name(path).alias("filename"),
    )


def _rule_chain(attribute: Column, pick: int, default: str) -> Column:
    chain = None
    for how, words, *values in ATTRIBUTE_RULES:
        test = attribute.isin(*words) if how == "=" else attribute.contains(words[0])
        value = F.lit(values[pick])
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain.otherwise(F.lit(default))


def infer_units(attribute: Column) -> Column:
    return _rule_chain(attribute, 0, "unknown")


def infer_signal_type(attribute: Column) -> Column:
    return _rule_chain(attribute, 1, "measurement")


def parse_pv_strict(pv: Column) -> Column:
    """``struct<device, area, location, attribute, units, signal_type>`` of DEVICE_AREA_NUMBER_ATTRIBUTE."""
    ok = pv.rlike(SIGNAL_NAME)

    def group(i):
        return F.when(ok, F.regexp_extract(pv, SIGNAL_NAME, i)).otherwise(F.lit("unknown"))

    attribute = F.when(ok, F.regexp_extract(pv, SIGNAL_NAME, 4)).otherwise(pv)
    return F.struct(
        group(1).alias("device"),
        group(2).alias("area"),
        group(3).alias("location"),
        attribute.alias("attribute"),
        F.when(ok, infer_units(attribute)).otherwise(F.lit("unknown")).alias("units"),
        F.when(ok, infer_signal_type(attribute)).otherwise(F.lit("unknown")).alias("signal_type"),
    )


def parse_pv_split(pv: Column) -> Column:
    """First four ``_`` parts; a fifth and later part is dropped. Valid from three parts on."""
    parts = split_plain(pv, "_")

    def part(i):
        return F.coalesce(F.get(parts, i), F.lit(""))

    return F.struct(
        part(0).alias("device_type"),
        part(1).alias("device_area"),
        part(2).alias("device_location"),
        part(3).alias("measurement_type"),
        (F.size(parts) >= 3).alias("valid"),
    )


def parse_pv_colon(pv: Column) -> Column:
    """``:`` parts, missing ones ``UNKNOWN``."""
    parts = split_plain(pv, ":")

    def part(i):
        return F.coalesce(F.get(parts, i), F.lit("UNKNOWN"))

    return F.struct(
        part(0).alias("device"), part(1).alias("area"), part(2).alias("location"), part(3).alias("attribute")
    )


def to_colon_form(pv: Column) -> Column:
    """``A_B_C_REST`` as ``A:B:C:REST``; other names unchanged."""
    return F.regexp_replace(pv, r"^([^_]+)_([^_]+)_([^_]+)_(.+)$", "$1:$2:$3:$4")


def parse_pv_spatial(pv: Column, sep: str = ":") -> Column:
    """Four name parts for enrichment; fewer than four make the name invalid and its parts empty."""
    parts = split_plain(to_colon_form(pv) if sep == "_" else pv, ":")
    valid = F.size(parts) >= 4

    def part(i):
        return F.when(valid, F.get(parts, i)).otherwise(F.lit(""))

    return F.struct(
        part(0).alias("device_type"),
        part(1).alias("area"),
        part(2).alias("position"),
        part(3).alias("attribute"),
        valid.alias("valid"),
    )
