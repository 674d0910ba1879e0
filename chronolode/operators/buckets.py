"""Buckets: packing samples, range queries, pages and column operations."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolode.functions.timestamps import day_of, div, nanos_part, seconds_part
from chronolode.functions.status import sample_conditions, status_runs
from chronolode.functions.values import array_slice
from chronolode.operators.axis import computed, expand_timestamps, timestamp_bounds, timestamp_count, with_condition
from chronolode.operators.ranks import running_offset, small_side, with_global_rank
from chronolode.session import cut_lineage
from chronolode.schema import LIST, NS_PER_DAY, NS_PER_SEC

# Samples one packed bucket may hold before its day is split.
MAX_BUCKET_SAMPLES = 1_000_000


def bucket_id(pv: Column, first_ns: Column) -> Column:
    """``pv-<seconds>-<nanoseconds>`` of the first sample."""
    return F.concat_ws("-", pv, seconds_part(first_ns).cast("string"), nanos_part(first_ns).cast("string"))


def _numbered(full: DataFrame, order: list[str]) -> DataFrame:
    """Samples with ``__pos``, their 0-based place in time within their signal and day."""
    ranked = with_global_rank(full, "pv", *order, name="__rank")
    firsts = ranked.groupBy("pv", "day").agg(F.min("__rank").alias("__first"))
    return ranked.join(firsts, ["pv", "day"]).withColumn("__pos", F.col("__rank") - F.col("__first")).drop("__rank", "__first")


def bucket_groups(samples: DataFrame, max_samples: int, order: list[str]) -> tuple[DataFrame, list[str]]:
    """Samples with ``day`` and the columns whose equal values make a bucket.

    A day with more than ``max_samples`` gets ``__part`` as well, by runs of that many in the order of ``order``. Which
    days need this is counted first; their samples are numbered by sorted ranges.
    """
    keyed = samples.withColumn("day", day_of(F.col("ts_ns")))
    groups = ["pv", "day"]
    full_days = keyed.groupBy("pv", "day").agg(F.count("*").alias("__n")).where(F.col("__n") > max_samples)
    full_days = full_days.select("pv", "day")
    n_full = full_days.count()
    if not n_full:
        return keyed, groups
    full_days = small_side(cut_lineage(full_days), n_full)
    usual = keyed.join(full_days, groups, "left_anti").withColumn("__part", F.lit(0).cast("bigint"))
    full = _numbered(keyed.join(full_days, groups, "left_semi"), order)
    full = full.withColumn("__part", div(F.col("__pos"), max_samples)).select(*usual.columns)
    return usual.unionByName(full), [*groups, "__part"]


def bucket_head(groups: list[str]) -> list[Column]:
    """Identity and time axis of a list bucket whose sorted samples are ``__s``.

    From its second bucket on, a day's bucket ids end with the number of the bucket, as several can begin at one
    instant.
    """
    first, last = F.get("__s", 0)["ts_ns"], F.element_at("__s", -1)["ts_ns"]
    id = bucket_id(F.col("pv"), first)
    if "__part" in groups:
        part = F.col("__part")
        id = F.when(part == 0, id).otherwise(F.concat_ws("-", id, F.lpad(part.cast("string"), 9, "0")))
    return [
        id.alias("bucket_id"),
        F.col("pv"),
        first.alias("first_ns"),
        last.alias("last_ns"),
        F.size("__s").cast("bigint").alias("sample_count"),
        F.lit(0).cast("bigint").alias("period_ns"),
        F.lit(LIST).alias("ts_kind"),
        F.col("__s.ts_ns").alias("ts_ns"),
    ]


def pack_buckets(samples: DataFrame, max_samples: int = MAX_BUCKET_SAMPLES, status: bool = False) -> DataFrame:
    """Samples as list buckets, one per signal and UTC day.

    A day with more than ``max_samples`` is cut into buckets of that many in
    time order, so no bucket grows with a hot signal and buckets of a signal
    follow each other in time. With ``status``, samples also have severity, status
    and message, which are stored as runs.
    """
    conditions = ["severity", "status", "message"] if status else []
    order = ["ts_ns", "value", *conditions]
    keyed, groups = bucket_groups(samples.select("pv", *order), max_samples, order)
    packed = keyed.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("__s"))
    return packed.select(
        *bucket_head(groups),
        F.lit("DOUBLE").alias("data_type"),
        F.col("__s.value").alias("vals"),
        *([status_runs(F.col("__s")).alias("status_runs")] if status else []),
        "day",
    )


def request_rows(requests: DataFrame, *keep: str) -> DataFrame:
    """One row per column ``c`` of every request, with columns ``keep``; no shuffle."""
    first, last = timestamp_bounds(F.col("ts"))
    return requests.select(
        "provider_id",
        "request_id",
        "ts",
        "tags",
        "attributes",
        "event",
        F.col("received_ns").alias("created_ns"),
        first.alias("first_ns"),
        last.alias("last_ns"),
        # outer, then tested: the plain form would first build every column only to see that there is one
        F.explode_outer("columns").alias("c"),
        *keep,
    ).where(F.col("c").isNotNull())


def request_head() -> list[Column]:
    """What a bucket has before its values, from :func:`request_rows`."""
    return [
        bucket_id(F.col("c.name"), F.col("first_ns")).alias("bucket_id"),
        F.col("c.name").alias("pv"),
        F.col("provider_id"),
        F.col("request_id"),
        F.col("first_ns"),
        F.col("last_ns"),
        timestamp_count(F.col("ts")).alias("sample_count"),
        F.when(F.col("ts.kind") == LIST, F.lit(0)).otherwise(F.col("ts.period_ns")).cast("bigint").alias("period_ns"),
        F.col("ts.kind").alias("ts_kind"),
        F.col("ts.ts_ns").alias("ts_ns"),
    ]


def request_tail() -> list[Column]:
    """What a bucket has after its values."""
    return [*map(F.col, ["tags", "attributes", "event", "created_ns"]), day_of(F.col("first_ns")).alias("day")]


def request_buckets(requests: DataFrame, *keep: str) -> DataFrame:
    """One DOUBLE bucket per column of every request, with columns ``keep``; no shuffle."""
    vals = F.col("c.vals").alias("vals")
    return request_rows(requests, *keep).select(*request_head(), F.lit("DOUBLE").alias("data_type"), vals, *request_tail(), *keep)


# --- range queries ---------------------------------------------------------


def select_pvs(df: DataFrame, names: list[str] | str | None = None, pattern: str | None = None) -> DataFrame:
    """Rows of the named signals (list or comma text), or of those a regular expression finds."""
    if names is not None:
        wanted = names.split(",") if isinstance(names, str) else names
        return df.where(F.col("pv").isin(*[n for n in wanted if n]))
    return df.where(F.col("pv").rlike(pattern)) if pattern is not None else df


def query_buckets(
    buckets: DataFrame,
    begin_ns: int,
    end_ns: int,
    pvs: list[str] | str | None = None,
    pattern: str | None = None,
    end_inclusive: bool = False,
    max_span_days: int | None = None,
) -> DataFrame:
    """Buckets that overlap [begin, end).

    All tests are on plain columns and reach the Parquet scan; ``day`` prunes
    folders. How long a bucket may last bounds the days before ``begin`` as
    well: the store says it by its ``span_days`` folders; for other tables
    ``max_span_days`` can state it.
    """
    first, last = F.col("first_ns"), F.col("last_ns")
    out = select_pvs(buckets, pvs, pattern).where(last >= begin_ns)
    out = out.where(first <= end_ns) if end_inclusive else out.where(first < end_ns)
    if "day" in buckets.columns:
        lo = None if max_span_days is None else begin_ns // NS_PER_DAY - max_span_days
        out = _within(out, "day", lambda d: d, lo, end_ns // NS_PER_DAY)
        if "month" in buckets.columns:
            out = _within(out, "month", lambda d: F.trunc(d, "month"), lo, end_ns // NS_PER_DAY)
        if "span_days" in buckets.columns:
            latest = F.last_day("month") if "month" in buckets.columns else F.col("day")
            out = out.where(F.date_add(latest, F.col("span_days")) >= F.date_from_unix_date(F.lit(begin_ns // NS_PER_DAY)))
    return out


def _within(df: DataFrame, column: str, unit: Callable[[Column], Column], lo: int | None, hi: int) -> DataFrame:
    """Bounds on a folder column, so that Spark lists only the folders that can match."""
    df = df.where(F.col(column) <= unit(F.date_from_unix_date(F.lit(hi))))
    return df if lo is None else df.where(F.col(column) >= unit(F.date_from_unix_date(F.lit(lo))))


def query_samples(
    buckets: DataFrame,
    begin_ns: int,
    end_ns: int,
    pvs: list[str] | str | None = None,
    pattern: str | None = None,
    end_inclusive: bool = False,
    max_span_days: int | None = None,
) -> DataFrame:
    """``pv, bucket_id, ts_ns, value`` in [begin, end), and severity, status, message where buckets store them."""
    found = query_buckets(buckets, begin_ns, end_ns, pvs, pattern, end_inclusive, max_span_days)
    keep = ["pv", "bucket_id"]
    if "status_runs" in buckets.columns:
        found = computed(found, __conditions=sample_conditions(F.col("status_runs")))
        keep.append("__conditions")
    rows = expand_timestamps(found, *keep).where(F.col("ts_ns") >= begin_ns)
    if "status_runs" in buckets.columns:
        rows = with_condition(rows)
    rows = rows.drop("pos")
    return rows.where(F.col("ts_ns") <= end_ns) if end_inclusive else rows.where(F.col("ts_ns") < end_ns)


PAGE_ORDER = ("pv", "first_ns", "bucket_id")


def query_pages(df: DataFrame, size: int, order: tuple[str, ...] = PAGE_ORDER) -> DataFrame:
    """Add the 1-based ``page`` each row is delivered on."""
    return with_global_rank(df, *order).withColumn("page", div(F.col("rank") - 1, size) + 1).drop("rank")


def next_page(df: DataFrame, size: int, after: tuple | None = None, order: tuple[str, ...] = PAGE_ORDER) -> DataFrame:
    """The ``size`` rows after key ``after``: a cursor step as filter plus top-k, nothing is numbered."""
    if after is not None:
        beyond = F.lit(False)
        for i, column in enumerate(order):
            same = F.lit(True)
            for earlier, value in zip(order[:i], after[:i]):
                same = same & (F.col(earlier) == value)
            beyond = beyond | (same & (F.col(column) > after[i]))
        # the plain bound on the first key is what the scan can use
        df = df.where(F.col(order[0]) >= after[0]).where(beyond)
    return df.orderBy(*order).limit(size)


# --- columns ---------------------------------------------------------------


def column_filter(buckets: DataFrame, keep: Callable[[Column], Column]) -> DataFrame:
    """Values for which ``keep`` holds; a column left empty disappears."""
    return buckets.withColumn("vals", F.filter("vals", keep)).where(F.size("vals") > 0)


def column_slice(buckets: DataFrame, start: int, end: int) -> DataFrame:
    return buckets.withColumn("vals", array_slice(F.col("vals"), start, end))


def column_size(buckets: DataFrame) -> DataFrame:
    return buckets.withColumn("n", F.size("vals"))


def column_merge(buckets: DataFrame) -> DataFrame:
    """Columns of each signal one after the other as rows ``pv, pos, value``.

    Every bucket only learns how many values come before it; the values never
    meet in one group, whatever the length of the merged column.
    """
    hour = div(F.col("first_ns"), 3600 * NS_PER_SEC).alias("hour")
    shifted = running_offset(
        buckets.select("pv", hour, "first_ns", "bucket_id", "vals"),
        F.size("vals").cast("bigint"),
        "pv",
        "hour",
        "first_ns",
        "bucket_id",
    )
    rows = shifted.select("pv", "offset", F.posexplode("vals").alias("i", "value"))
    return rows.select("pv", (F.col("offset") + F.col("i")).alias("pos"), "value")


def tag_union(a: Column, b: Column) -> Column:
    """Sorted union of two tag lists."""
    return F.array_sort(F.array_union(a, b))
