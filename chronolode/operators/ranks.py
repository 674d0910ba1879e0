"""Positions in a total order, without one task seeing all rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolode.session import cut_lineage

_LOCAL_BITS = 33  # monotonically_increasing_id() is (partition << 33) + row in partition


# Rows and bytes up to which a checked side of a join is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# Rows for which not even long names come near that size.
FEW_ROWS = 5_000


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether the counted rows of ``df`` and their measured bytes allow a broadcast."""
    if rows <= FEW_ROWS or rows > BROADCAST_ROWS:
        return rows <= BROADCAST_ROWS
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() in ("string", "binary")]
    size = sum(texts, F.lit(16 + 16 * len(df.columns)))
    return (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows and their measured bytes allow it, else for a shuffle join.

    Without a mark Spark would go by its estimate, which a checkpointed table has from the plan behind it: exploded
    rows count as those they came from, and millions of them would be sent to the driver.
    """
    return F.broadcast(df) if is_small(df, rows) else df.hint("merge")


def with_global_rank(df: DataFrame, *order: str, name: str = "rank") -> DataFrame:
    """Add the 1-based position of every row in the order of ``order``.

    Range partitions are sorted side by side and then shifted by the sizes of
    the partitions before them. A lost executor must not re-draw the ranges
    between counting and numbering, hence the checkpoint. Rows equal in all of
    ``order`` get a tie number where they are read, so that many of them still
    spread over partitions; sorting first makes that number the same when a
    task runs again.
    """
    tied = df.sortWithinPartitions(*order).withColumn("__tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
    fixed = cut_lineage(ranged.withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", _LOCAL_BITS)
    sizes = fixed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    # one row per partition: this window and this broadcast are bounded by their number
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    local = F.col("__id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        fixed.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + local + 1)
        .drop("__id", "__part", "__start")
    )


def running_offset(df: DataFrame, size: Column, key: str, coarse: str, *order: str) -> DataFrame:
    """Add ``offset``: the sum of ``size`` over earlier rows of the same ``key``.

    Rows are first summed per (key, coarse) so that a hot key is spread over
    its coarse steps; only the few step totals of a key meet in one window.
    ``coarse`` must not decrease along ``order``.
    """
    sized = df.withColumn("__size", size)
    totals = sized.groupBy(key, coarse).agg(F.sum("__size").alias("__total"))
    steps = Window.partitionBy(key).orderBy(coarse).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, coarse, F.coalesce(F.sum("__total").over(steps), F.lit(0)).alias("__start"))
    within = Window.partitionBy(key, coarse).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sized.withColumn("__before", F.coalesce(F.sum("__size").over(within), F.lit(0)))
        .join(starts, [key, coarse])
        .withColumn("offset", F.col("__start") + F.col("__before"))
        .drop("__size", "__before", "__start")
    )
