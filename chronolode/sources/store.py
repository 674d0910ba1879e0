"""The bucket store: Parquet in day folders, sorted by signal.

Below its day a bucket lies in a folder that bounds the days it lasts
(``span_days``: 0, 1, 2, 4 and so on). So a query knows without being told how
far before its begin the folders go that it must open.
"""

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolode import schema
from chronolode.functions.timestamps import day_of
from chronolode.operators.axis import timestamp_bounds, timestamp_count
from chronolode.operators.buckets import request_buckets
from chronolode.operators.typed import typed_request_buckets


def laid_out(buckets: DataFrame, folder: str = "day", layout: str = "rebalance", partitions: int | None = None) -> DataFrame:
    """Buckets arranged for writing.

    ``rebalance`` is one pass: one partition per folder, and adaptive execution
    cuts those that are too big and joins those that are too small. ``range``
    looks at the data once more to find ranges of (day, signal, start); every
    file then covers few signals, and a hot signal is split by time. Either way
    rows are sorted by signal, so page statistics narrow what a query reads.
    """
    keys = [folder, "pv", "first_ns"]
    if layout == "rebalance":
        spread = buckets.hint("rebalance", folder)
    elif layout == "range":
        spread = buckets.repartitionByRange(*([partitions] if partitions else []), *keys)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return spread.sortWithinPartitions(*keys)


def save_buckets(
    buckets: DataFrame,
    path: str,
    mode: str = "append",
    folder: str = "day",
    layout: str = "rebalance",
    partitions: int | None = None,
) -> None:
    """Write buckets into ``day`` folders, or ``month`` folders where a day holds little data."""
    if folder == "month":
        buckets = buckets.withColumn("month", F.trunc("day", "month"))
    elif folder != "day":
        raise ValueError(f"unknown folder {folder!r}")
    rows = laid_out(with_span(buckets), folder, layout, partitions)
    _write(rows, path, mode, folder)


def _write(rows: DataFrame, path: str, mode: str, folder: str) -> None:
    rows.write.mode(mode).partitionBy(folder, "span_days").parquet(path)


def save_requests(requests: DataFrame, path: str, mode: str = "append", folder: str = "day") -> None:
    """Write one bucket per DOUBLE column of every consistent request, in one pass.

    Requests travel to their folder before they are cut into columns, so what columns share travels once.
    """
    first, _ = timestamp_bounds(F.col("ts"))
    day = day_of(first)
    place = F.trunc(day, "month") if folder == "month" else day
    fits = first.isNotNull() & F.exists("columns", lambda c: F.size(c["vals"]) == timestamp_count(F.col("ts")))
    needed = ["provider_id", "request_id", "ts", "tags", "attributes", "event", "received_ns", "columns"]
    spread = requests.where(fits).select(*needed, place.alias("__folder")).hint("rebalance", "__folder")
    buckets = with_span(consistent(request_buckets(spread)))
    if folder == "month":
        buckets = buckets.withColumn("month", F.trunc("day", "month"))
    elif folder != "day":
        raise ValueError(f"unknown folder {folder!r}")
    _write(buckets.sortWithinPartitions(folder, "pv", "first_ns"), path, mode, folder)


def with_span(buckets: DataFrame) -> DataFrame:
    """Add ``span_days``: the days from a bucket's day to that of its last instant, up to the next power of two."""
    days = F.datediff(day_of(F.col("last_ns")), F.col("day"))
    bound = F.pow(F.lit(2), F.ceil(F.log2(days.cast("double")))).cast("int")
    return buckets.withColumn("span_days", F.when(days > 0, bound).otherwise(0))


# What makes a stored bucket the same one when it is written again.
BUCKET_KEY = ["day", "pv", "provider_id", "request_id", "bucket_id"]


# Arrays with an entry for every sample; a bucket has those of its type.
PER_SAMPLE = ["vals", "longs", "flags", "codes", "blobs", "nested", "labels"]


def consistent(buckets: DataFrame) -> DataFrame:
    """Buckets with an instant for every value."""
    sizes = [F.when(F.col(c).isNotNull(), F.size(c)) for c in PER_SAMPLE if c in buckets.columns]
    return buckets.where(F.col("first_ns").isNotNull() & (F.coalesce(*sizes) == F.col("sample_count")))


def _stored(spark: SparkSession, path: str) -> bool:
    try:
        return not read_buckets(spark, path).isEmpty()
    except AnalysisException:  # no such path yet
        return False


# Days that a test names one by one; beyond, the first and the last bound it.
NAMED_DAYS = 1_000


def of_days(stored: DataFrame, days: list[date]) -> DataFrame:
    """Rows of a store that may be of the given days, so that Spark lists only their folders."""

    def among(column: str, values: set[date]) -> Column:
        if len(values) <= NAMED_DAYS:
            return F.col(column).isin(sorted(values))
        return F.col(column).between(min(values), max(values))

    out = stored.where(among("day", set(days))) if days else stored.where(F.lit(False))
    if days and "month" in stored.columns:
        out = out.where(among("month", {d.replace(day=1) for d in days}))
    return out


def insert_buckets(buckets: DataFrame, path: str, folder: str = "day") -> None:
    """Add the buckets a store does not have yet; inserting them again changes nothing.

    Keys of the days at hand are read from the store, never arrays. Every bucket is taken once, also when the input
    repeats it. Two inserts of the same buckets at one time can both add them: writers that run side by side need
    folders of their own, as streams have.
    """
    spark = buckets.sparkSession
    new = consistent(buckets).dropDuplicates(BUCKET_KEY)
    if _stored(spark, path):
        # days are few: a year has 366
        days = [r[0] for r in consistent(buckets).select("day").distinct().collect()]
        old = of_days(read_buckets(spark, path), days).select(*BUCKET_KEY)
        condition = F.col("n.day") == F.col("o.day")
        for c in BUCKET_KEY[1:]:
            condition = condition & F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
        new = new.alias("n").join(old.alias("o"), condition, "left_anti")
    save_buckets(new, path, "append", folder)


def write_buckets(requests: DataFrame, path: str, mode: str = "insert", folder: str = "day") -> DataFrame:
    """Store one bucket per column of every consistent request; returns the stored table.

    Columns have ``vals`` of DOUBLE, or ``values`` of any type (see :func:`typed_request_buckets`).
    ``insert`` adds what the store lacks, so a repeated call changes nothing.
    ``overwrite`` and ``append`` write in one pass without looking.
    """
    typed = "values" in requests.schema["columns"].dataType.elementType.names
    buckets = typed_request_buckets(requests) if typed else request_buckets(requests)
    if mode == "insert":
        insert_buckets(buckets, path, folder)
    elif not typed:
        save_requests(requests, path, mode, folder)
    else:
        save_buckets(consistent(buckets), path, mode, folder)
    return read_buckets(requests.sparkSession, path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.BUCKETS).parquet(path)


def compact_day(spark: SparkSession, source: str, target: str, day: str, partitions: int | None = None) -> None:
    """Rewrite one day of a store into clustered files of another store, in place of what that has of the day."""
    one = read_buckets(spark, source).where(F.col("day") == F.lit(day).cast("date"))
    writer = laid_out(with_span(one), "day", "range", partitions).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("day", "span_days").parquet(target)
