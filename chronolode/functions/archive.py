"""Column functions for archiver points: alarm names, validity, signal kind."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alarm severities and statuses by their number.
SEVERITIES = ["NO_ALARM", "MINOR", "MAJOR", "INVALID"]
STATUSES = [
    "NO_ALARM", "READ", "WRITE", "HIHI", "HIGH", "LOLO", "LOW", "STATE", "COS", "COMM", "TIMEOUT",
    "HWLIMIT", "CALC", "SCAN", "LINK", "SOFT", "BAD_SUB", "UDF", "DISABLE", "SIMM", "READ_ACCESS",
    "WRITE_ACCESS",
]
# Signal type of a device without enumerated states.
SIGNAL_TYPE_BY_DEVICE = {"IOC": "control", "STPR": "status"}


def _named(code: Column, names: list[str]) -> Column:
    return F.coalesce(F.get(F.array(*map(F.lit, names)), code), F.lit("UNKNOWN"))


def severity_name(severity: Column) -> Column:
    return _named(severity, SEVERITIES)


def status_name(status: Column) -> Column:
    return _named(status, STATUSES)


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def point_valid(value: Column, severity: Column) -> Column:
    return is_finite(value) & (severity < 3)


def mask_invalid(value: Column, severity: Column) -> Column:
    """The value of a valid point, NaN for any other; no row is lost."""
    return F.when(point_valid(value, severity), value).otherwise(F.lit(float("nan")))


def archive_signal_type(device: Column, enums: Column) -> Column:
    chain = F.when(F.size(enums) > 0, F.lit("enum"))
    for name, kind in SIGNAL_TYPE_BY_DEVICE.items():
        chain = chain.when(device == name, F.lit(kind))
    return chain.otherwise(F.lit("scalar"))
