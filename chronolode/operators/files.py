"""Operators over file listings and decoded signal files."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolode.functions.names import file_of_parts, file_parts, parse_file_strict, parse_pv_strict
from chronolode.operators.ranks import with_global_rank

# Limits usual for imports; none applies unless it is passed.
MIN_FILE_BYTES = 1024
MAX_FILE_BYTES = 10 * 1024**3
MAX_OBJECTS = 10_000
MAX_SAMPLES = 10_000_000

# Datasets of a signal file that hold time, not signals.
TIME_DATASETS = ("secondsPastEpoch", "nanoseconds")


def size_fault(lo: int | None, hi: int | None) -> Column:
    """Why a file of this size is refused; NULL if it is not."""
    size, fault = F.col("file_bytes"), F.lit(None).cast("string")
    if hi is not None:
        fault = F.when(size > hi, "too large").otherwise(fault)
    return fault if lo is None else F.when(size < lo, "too small").otherwise(fault)


def file_admission(files: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Add ``admitted`` and ``reason``."""
    checked = files.withColumn("reason", F.coalesce(size_fault(lo, hi), F.lit("")))
    return checked.select(*files.columns, (F.col("reason") == "").alias("admitted"), "reason")


def file_order(files: DataFrame) -> DataFrame:
    """Add ``ord``: smaller files first, the path as tie-break."""
    return with_global_rank(files, "file_bytes", "path", name="ord")


def resume_filter(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose path is not in the manifest of processed files."""
    return files.join(manifest.select("path"), "path", "left_anti")


def append_manifest(done: DataFrame, path: str) -> None:
    """Add the paths of successful files to the manifest."""
    done.where("ok").select("path").write.mode("append").parquet(path)


def _usable(max_objects: int | None) -> Column:
    signal = ~F.col("signal_name").isin(*TIME_DATASETS)
    return signal if max_objects is None else signal & (F.col("n_objects") <= max_objects)


def signal_catalog(raw: DataFrame, max_objects: int | None = None) -> DataFrame:
    """Signals of each file; with a limit, a file with more objects has none."""
    return raw.where(_usable(max_objects))


def file_signal_counts(raw: DataFrame, max_objects: int | None = None) -> DataFrame:
    """``path, signals, ok``: a file without a signal has failed."""
    usable = _usable(max_objects)
    counts = raw.groupBy("path").agg(F.count_if(usable).alias("signals"))
    return counts.withColumn("ok", F.col("signals") > 0)


def signal_cap(signals: DataFrame, n: int = 1000, *tie: str) -> DataFrame:
    """The first ``n`` signals of each file by name.

    Spark limits the rows of each file before the shuffle as well, so a file
    with very many signals does not travel whole.
    """
    order = Window.partitionBy("path").orderBy("signal_name", *tie)
    return signals.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") <= n).drop("__rn")


def ts_bounds(signals: DataFrame, count: Column, max_samples: int | None = None) -> DataFrame:
    return signals.where(count >= 1) if max_samples is None else signals.where(count.between(1, max_samples))


def validate_signal(signals: DataFrame, vals: Column, count: Column) -> DataFrame:
    """Add ``ok`` and ``reason``: lengths must agree and not be zero; NaN is no fault."""
    n = F.size(vals)
    reason = F.when(count.isNull(), "no time axis").when(n != count, "length mismatch").when(n == 0, "empty")
    return signals.withColumn("reason", F.coalesce(reason, F.lit(""))).withColumn("ok", F.col("reason") == "")


def with_parsed_names(raw: DataFrame) -> DataFrame:
    """Add the parsed file name and signal name as ``file`` and ``info``."""
    return raw.withColumn("file", parse_file_strict(F.col("path"))).withColumn(
        "info", parse_pv_strict(F.col("signal_name"))
    )


def signals_by(
    raw: DataFrame,
    device: str | None = None,
    area: str | None = None,
    attribute: str | None = None,
    project: str | None = None,
    name: str | None = None,
) -> DataFrame:
    """Signals by the parts of their name, their file's project, or the full name."""
    wanted = {
        "info.device": device,
        "info.area": area,
        "info.attribute": attribute,
        "file.project": project,
        "signal_name": name,
    }
    out = with_parsed_names(raw)
    for column, value in wanted.items():
        if value is not None:
            out = out.where(F.col(column) == value)
    return out


def file_metadata_distinct(raw: DataFrame) -> DataFrame:
    """One row per file with its parsed name and the number of its signals.

    ``explode`` makes the parts of the name a real column: expressions over groups are otherwise made part of the
    aggregation, which repeats their making for every field.
    """
    files = raw.groupBy("path").agg(F.count_if(~F.col("signal_name").isin(*TIME_DATASETS)).alias("signals"))
    cut = files.select("path", "signals", F.explode(F.array(file_parts(F.col("path")))).alias("parts"))
    return cut.select("path", file_of_parts(F.col("parts")).alias("file"), "signals").select("path", "file.*", "signals")
