"""Aggregations over samples, archiver points, buckets and run logs.

NaN counts as missing in every statistic; Inf is data and stays.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolode.functions.archive import is_finite, point_valid
from chronolode.functions.timestamps import div
from chronolode.operators.buckets import select_pvs
from chronolode.operators.median import SKETCH_KNOWS, sketch, with_exact_median

# Tags every imported file signal starts with.
FILE_TAGS = ("h5_data", "accelerator_data", "production")


def _present(value: str = "value") -> Column:
    return F.nanvl(F.col(value), F.lit(None).cast("double"))


def _moments() -> list[Column]:
    v = _present()
    return [
        F.count(v).alias("count"),
        F.count_if(F.isnan("value")).alias("nan_count"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std_dev"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    ]


def pv_statistics(samples: DataFrame, zero_fill: bool = False, hot_samples: int = SKETCH_KNOWS, approx: bool = False) -> DataFrame:
    """``pv, count, nan_count, mean, median, std_dev, min, max`` with the exact median.

    One scan gives all of it for signals of at most ``hot_samples`` samples (never more than the sketch knows exactly);
    the median of others takes a second scan, in which only values around the middle are shuffled. ``approx`` trades
    exactness of the median for one scan.
    """
    columns = ["pv", "count", "nan_count", "mean", "median", "std_dev", "min", "max"]
    if approx:
        result = samples.groupBy("pv").agg(*_moments(), F.percentile_approx(_present(), 0.5, 10_000).alias("median"))
    else:
        first = samples.groupBy("pv").agg(*_moments(), sketch(_present()).alias("__sketch"))
        result = with_exact_median(first, samples.where(~F.isnan("value")), "pv", "value", hot_samples)
    if zero_fill:
        result = result.fillna(0.0, ["mean", "median", "std_dev", "min", "max"])
    return result.select(*columns)


def table_summary(samples: DataFrame) -> DataFrame:
    """``pv, count, min, max, mean``."""
    v = _present()
    return samples.groupBy("pv").agg(
        F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean")
    )


def data_summary(samples: DataFrame) -> DataFrame:
    """``pv, points, first_value, last_value`` by time; NaN is a point too."""
    return samples.groupBy("pv").agg(
        F.count("*").alias("points"),
        F.min_by("value", F.struct("ts_ns", "value")).alias("first_value"),
        F.max_by("value", F.struct("ts_ns", "value")).alias("last_value"),
    )


def quality_counts(samples: DataFrame) -> DataFrame:
    """``pv, valid, nan, inf, ratio``."""
    nan, finite = F.isnan("value"), is_finite(F.col("value"))
    counted = samples.groupBy("pv").agg(
        F.count_if(finite).alias("valid"),
        F.count_if(nan).alias("nan"),
        F.count_if(~nan & ~finite).alias("inf"),
        F.count("*").alias("__n"),
    )
    return counted.withColumn("ratio", F.col("valid") / F.col("__n")).drop("__n")


def quality_tags(counts: DataFrame, base: tuple[str, ...] = FILE_TAGS) -> DataFrame:
    """Add ``tags`` to the result of :func:`quality_counts`."""
    flags = [
        F.when(F.col("nan") > 0, F.lit("contains_nan")),
        F.when(F.col("inf") > 0, F.lit("contains_inf")),
        F.when((F.col("nan") == 0) & (F.col("inf") == 0), F.lit("all_valid")),
    ]
    return counts.withColumn("tags", F.array_compact(F.array(*[F.lit(t) for t in base], *flags)))


def period_mean(points: DataFrame, key: str = "pv") -> DataFrame:
    """Mean gap per signal in whole nanoseconds; one second for a single sample."""
    span = points.groupBy(key).agg(
        F.min("ts_ns").alias("__lo"), F.max("ts_ns").alias("__hi"), F.count("*").alias("__n")
    )
    gap = div(F.col("__hi") - F.col("__lo"), F.greatest(F.col("__n") - 1, F.lit(1)))
    return span.select(key, F.when(F.col("__n") > 1, gap).otherwise(F.lit(1_000_000_000)).alias("period_ns"))


def archive_quality(points: DataFrame, key: str = "pv", has_enums: str | None = None) -> DataFrame:
    """Valid and alarm counts of archiver points, with the quality tags."""
    ok = point_valid(F.col("value"), F.col("severity"))
    enums = F.lit(False) if has_enums is None else F.max(has_enums)
    counted = points.groupBy(key).agg(
        F.count_if(ok).alias("valid_count"),
        F.count("*").alias("total"),
        F.count_if(F.col("severity") > 0).alias("alarm_count"),
        enums.alias("has_enums"),
    )
    pct = F.col("valid_count") / F.col("total") * 100
    return counted.withColumn("valid_pct", pct).withColumn(
        "tags",
        F.array_compact(
            F.array(
                F.when(F.col("has_enums"), F.lit("has_enums")),
                F.when(F.col("alarm_count") > 0, F.lit("has_alarms")),
                F.when(F.col("valid_pct") > 90, F.lit("high_quality_data")),
                F.when(F.col("valid_pct") < 10, F.lit("low_quality_data")),
            )
        ),
    )


def pv_metadata(buckets: DataFrame, pvs: list[str] | str | None = None, pattern: str | None = None) -> DataFrame:
    """What is known per signal from its buckets; the last bucket is the one that ends last."""
    buckets = select_pvs(buckets, pvs, pattern)
    last = F.max_by(
        F.struct("bucket_id", "data_type", "ts_kind", "sample_count", "period_ns"), F.struct("last_ns", "bucket_id")
    )
    grouped = buckets.groupBy("pv").agg(
        last.alias("__last"),
        F.min("first_ns").alias("first_ns"),
        F.max("last_ns").alias("last_ns"),
        F.count("*").alias("num_buckets"),
        F.sum("sample_count").alias("total_samples"),
    )
    return grouped.select(
        "pv",
        F.col("__last.bucket_id").alias("last_bucket_id"),
        F.col("__last.data_type").alias("last_data_type"),
        F.col("__last.ts_kind").alias("last_ts_kind"),
        F.col("__last.sample_count").alias("last_bucket_sample_count"),
        F.col("__last.period_ns").alias("last_period_ns"),
        "first_ns",
        "last_ns",
        "num_buckets",
        "total_samples",
    )


def pv_list(buckets: DataFrame, pattern: str = ".*") -> DataFrame:
    """Signal names that match, with the counts of the verbose listing."""
    return pv_metadata(buckets, pattern=pattern).select("pv", "last_bucket_sample_count", "num_buckets")


def provider_pvs(buckets: DataFrame) -> DataFrame:
    """``provider_id, pv``: the signals of each provider as rows, so no list outgrows a task."""
    return buckets.select("provider_id", "pv").distinct()


def provider_metadata(buckets: DataFrame, provider_id: str | None = None) -> DataFrame:
    """First and last bucket, bucket count and signal count of each provider.

    Buckets are first reduced per (provider, signal), which spreads a hot provider.
    """
    if provider_id is not None:
        buckets = buckets.where(F.col("provider_id") == provider_id)
    per_pv = buckets.groupBy("provider_id", "pv").agg(
        F.min("first_ns").alias("first_ns"), F.max("last_ns").alias("last_ns"), F.count("*").alias("n")
    )
    return per_pv.groupBy("provider_id").agg(
        F.count("*").alias("num_pvs"),
        F.min("first_ns").alias("first_ns"),
        F.max("last_ns").alias("last_ns"),
        F.sum("n").alias("num_buckets"),
    )


def ingest_summary(log: DataFrame) -> DataFrame:
    """One row about a run: files by outcome, success rate, signals, size and rate.

    ``log`` has ok, file_bytes, signals and seconds per file.
    """
    one = log.agg(
        F.count_if("ok").alias("files_ok"),
        F.count_if(~F.col("ok")).alias("files_failed"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("signals"))), F.lit(0)).alias("signals"),
        (F.sum("file_bytes") / F.lit(float(1 << 30))).alias("total_gb"),
        F.sum("seconds").alias("__sec"),
    )
    files = F.col("files_ok") + F.col("files_failed")
    busy = F.col("__sec") > 0
    return one.select(
        "files_ok",
        "files_failed",
        F.when(files > 0, F.col("files_ok") * 100.0 / files).alias("success_pct"),
        "signals",
        "total_gb",
        F.when(busy, F.col("files_ok") / F.col("__sec")).alias("files_per_sec"),
        F.when(busy, F.col("total_gb") / F.col("__sec")).alias("gb_per_sec"),
    )


def ingest_ema(
    log: DataFrame, group: str, order: list[str], seconds: str = "seconds", alpha: float = 0.1, cap: float = 300.0
) -> DataFrame:
    """Moving average of file time in completion order, starting from zero.

    The fold e = (1 - a) e + a x is composed of pairs (factor, sum): a stretch of rows turns e into factor * e + sum.
    Sorted ranges of (group, order) each fold their own rows to one pair per group, and a group's few pairs are composed
    in the order of the ranges. Rows are never numbered, and only pairs travel by group.
    """
    rows = log.select(group, *order, F.least(F.col(seconds).cast("double"), F.lit(cap)).alias("__x"))
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).select(group, "__x")
    pair = T.StructType([T.StructField(group, log.schema[group].dataType), *PAIR])
    pairs = ranged.mapInArrow(_folded(alpha), pair)
    ordered = F.array_sort(F.collect_list(F.struct("__range", "__factor", "__sum")))  # one for each range at most
    whole = F.aggregate(ordered, F.lit(0.0), lambda e, p: e * p["__factor"] + p["__sum"])
    return pairs.groupBy(group).agg(whole.alias("ema"))


PAIR = [T.StructField("__range", T.IntegerType()), T.StructField("__factor", T.DoubleType()), T.StructField("__sum", T.DoubleType())]


def _folded(alpha: float):
    """One (factor, sum) for every group of a sorted range; a group may go on from batch to batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no = TaskContext.get().partitionId()
        key, factor, total, begun = None, 1.0, 0.0, False

        def out(schema: pa.Schema) -> pa.RecordBatch:
            columns = [pa.array([key], schema.field(0).type), pa.array([range_no], pa.int32()), pa.array([factor]), pa.array([total])]
            return pa.RecordBatch.from_arrays(columns, names=[schema.field(0).name, "__range", "__factor", "__sum"])

        for batch in batches:
            if not len(batch):
                continue
            groups = batch.column(0)
            same = pc.coalesce(pc.equal(groups[1:], groups[:-1]), pc.and_(pc.is_null(groups[1:]), pc.is_null(groups[:-1])))
            edges = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1).tolist(), len(batch)]
            values = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in zip(edges, edges[1:]):
                now = groups[a].as_py()
                if begun and now != key:
                    yield out(batch.schema)
                    factor, total = 1.0, 0.0
                key, begun = now, True
                powers = (1 - alpha) ** np.arange(b - a - 1, -1, -1)
                total = total * (1 - alpha) ** (b - a) + alpha * float(values[a:b] @ powers)
                factor *= (1 - alpha) ** (b - a)
        if begun:
            yield out(batch.schema)

    return run
