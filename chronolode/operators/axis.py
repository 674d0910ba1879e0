"""From packed time axes to rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolode.functions.timestamps import clock_duration_ns, clock_frequency_hz
from chronolode.schema import CLOCK, LIST


def computed(df: DataFrame, **made: Column) -> DataFrame:
    """Add columns that are computed once, however often later expressions use them.

    ``inline`` keeps the optimizer from copying their expressions into every use.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def expand_clock(buckets: DataFrame, *keep: str) -> DataFrame:
    """Samples of clock buckets: ``keep..., pos, ts_ns, value``."""
    rows = buckets.select(*keep, "first_ns", "period_ns", F.posexplode("vals").alias("pos", "value"))
    instant = F.col("first_ns") + F.col("pos").cast("bigint") * F.col("period_ns")
    return rows.select(*keep, "pos", instant.alias("ts_ns"), "value")


def expand_timestamps(buckets: DataFrame, *keep: str) -> DataFrame:
    """Samples of clock and list buckets: ``keep..., pos, ts_ns, value``."""
    rows = buckets.select(
        *keep,
        "ts_kind",
        "first_ns",
        "period_ns",
        F.col("ts_ns").alias("__list"),
        F.posexplode("vals").alias("pos", "value"),
    )
    instant = F.when(
        F.col("ts_kind") == CLOCK, F.col("first_ns") + F.col("pos").cast("bigint") * F.col("period_ns")
    ).when(F.col("ts_kind") == LIST, F.get("__list", F.col("pos")))
    return rows.select(*keep, "pos", instant.alias("ts_ns"), "value")


def with_condition(rows: DataFrame) -> DataFrame:
    """Severity, status and message of each sample, from ``__conditions`` by its ``pos``; none means all normal."""
    at = F.get("__conditions", F.col("pos"))
    return rows.withColumns(
        {"severity": F.coalesce(at["severity"], F.lit(0)), "status": F.coalesce(at["status"], F.lit(0)), "message": at["message"]}
    ).drop("__conditions")


def timestamp_count(ts: Column) -> Column:
    """Number of instants of a timestamps struct, by its kind."""
    return (
        F.when(ts["kind"] == CLOCK, ts["count"])
        .when(ts["kind"] == LIST, F.size(ts["ts_ns"]).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )


def timestamp_bounds(ts: Column) -> tuple[Column, Column]:
    """First and last instant of a timestamps struct."""
    first = F.when(ts["kind"] == CLOCK, ts["start_ns"]).otherwise(F.array_min(ts["ts_ns"]))
    last = F.when(ts["kind"] == CLOCK, ts["start_ns"] + ts["period_ns"] * (ts["count"] - 1)).otherwise(
        F.array_max(ts["ts_ns"])
    )
    return first, last


def regular_series(df: DataFrame, start: str, interval_ms: str, count: str, *keep: str) -> DataFrame:
    """``keep..., pos, ts_ns``: ``count`` instants from ``start``, ``interval_ms`` apart."""
    steps = F.sequence(F.lit(0).cast("bigint"), F.col(count).cast("bigint") - 1)
    rows = df.where(F.col(count) > 0).withColumn("pos", F.explode(steps))
    instant = F.col(start) + F.col("pos") * F.col(interval_ms) * F.lit(1_000_000)
    return rows.select(*keep, "pos", instant.alias("ts_ns"))


def clock_stats(buckets: DataFrame) -> DataFrame:
    """Add ``freq_hz`` and ``duration_ns`` from period and sample count."""
    return buckets.withColumn("freq_hz", clock_frequency_hz(F.col("period_ns"))).withColumn(
        "duration_ns", clock_duration_ns(F.col("period_ns"), F.col("sample_count"))
    )


def regular_sampling(samples: DataFrame, checks: int = 10, tol: int = 1000) -> DataFrame:
    """``pv, regular``: the first ``checks`` gaps all within ``tol`` ns of the first gap.

    Only the first ``checks`` + 1 rows per signal pass the window; Spark cuts
    each task to them before the shuffle, so hot signals do not travel whole.
    """
    order = Window.partitionBy("pv").orderBy("ts_ns")
    head = (
        samples.select("pv", "ts_ns", F.row_number().over(order).alias("__rn"))
        .where(F.col("__rn") <= checks + 1)
        .withColumn("__gap", F.col("ts_ns") - F.lag("ts_ns").over(order))
    )
    first_gap = F.max(F.when(F.col("__rn") == 2, F.col("__gap")))
    spread = head.groupBy("pv").agg(
        F.count("*").alias("__n"),
        first_gap.alias("__p"),
        F.min("__gap").alias("__lo"),
        F.max("__gap").alias("__hi"),
    )
    within = (F.col("__hi") - F.col("__p") <= tol) & (F.col("__p") - F.col("__lo") <= tol)
    return spread.select("pv", F.when(F.col("__n") < 3, F.lit(True)).otherwise(within).alias("regular"))
