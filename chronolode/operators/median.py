"""Exact median per signal in at most two scans, whatever a signal's size.

Spark's ``median`` keeps all distinct values of a group in one buffer. Here the first scan makes one bounded sketch per
signal (``percentile_approx``), whose ranks are off by at most a share ``1 / ACCURACY`` of the values. Of few values it
knows every rank, so their median is read from it. For the others it gives two values with the middle between them. The
second scan counts what lies below the lower one and counts the few values between the two, where the middle ranks are
then found. Values outside never travel.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolode.operators.ranks import small_side
from chronolode.session import cut_lineage

ACCURACY = 10_000
# Values whose ranks in the sketch are off by less than half a rank.
SKETCH_KNOWS = 4_000
# Share of the values by which the middle is bracketed on either side, several times the error.
MARGIN = 5e-4


def sketch(value: Column) -> Column:
    """Lower bracket, middle, next value of small even groups, upper bracket; NULLs do not count."""
    shares = [0.5 - MARGIN, 0.5, 0.5 + 0.5 / SKETCH_KNOWS, 0.5 + MARGIN]
    return F.percentile_approx(value, shares, ACCURACY)


def sketch_median(found: Column, n: Column) -> Column:
    """The median where the sketch knows all ranks; mean of the middle two for even counts."""
    return F.when(n % 2 == 1, found[1]).otherwise(found[1] * 0.5 + found[2] * 0.5)


def bracketed_median(values: DataFrame, brackets: DataFrame, key: str, value: str) -> DataFrame:
    """``key, median`` for ``brackets`` (key, n, low, high), from one scan of ``values`` without NaN or NULL."""
    near = values.select(key, F.col(value).alias("__value")).join(brackets, key).where(F.col("__value") <= F.col("high"))
    inner = F.when(F.col("__value") >= F.col("low"), F.col("__value")).alias("__inner")
    counted = near.groupBy(key, inner).agg(F.count("*").alias("__c"), F.first("n").alias("n"))
    upto = F.sum("__c").over(Window.partitionBy(key).orderBy(F.asc_nulls_first("__inner")))
    placed = counted.withColumn("__upto", upto).where(F.col("__inner").isNotNull())

    def has(rank: str) -> Column:
        k = F.expr(rank)
        return ((F.col("__upto") >= k) & (F.col("__upto") - F.col("__c") < k)).cast("int")

    share = (has("(n + 1) div 2") + has("n div 2 + 1")) * 0.5
    # 0.0 times an infinity would be NaN
    return placed.where(share > 0).groupBy(key).agg(F.sum(F.col("__inner") * share).alias("median"))


def with_exact_median(first: DataFrame, values: DataFrame, key: str, value: str, known: int = SKETCH_KNOWS) -> DataFrame:
    """``first`` (key, count, __sketch, ...) with ``median`` in place of the sketch.

    ``first`` comes from one scan of ``values`` and is written once. Signals of more than ``known`` values are looked up in
    a second one; if there are none, it does not take place.
    """
    known = min(known, SKETCH_KNOWS)
    first = cut_lineage(first)
    rest = first.where(F.col("count") > known)
    n_rest = rest.count()
    found = F.when(F.col("count") > 0, sketch_median(F.col("__sketch"), F.col("count")))
    if not n_rest:
        return first.withColumn("median", found).drop("__sketch")
    brackets = rest.select(key, F.col("count").alias("n"), F.col("__sketch")[0].alias("low"), F.col("__sketch")[3].alias("high"))
    medians = bracketed_median(values, small_side(brackets, n_rest), key, value).withColumnRenamed("median", "__exact")
    both = first.join(medians, key, "left").withColumn("median", F.when(F.col("count") > known, F.col("__exact")).otherwise(found))
    return both.drop("__sketch", "__exact")


def radix_median(values: DataFrame, key: str = "pv", value: str = "value", small_rest: int = SKETCH_KNOWS) -> DataFrame:
    """``key, median`` over non-NaN values; mean of the middle two for even counts.

    Keys of at most ``small_rest`` values take the sketch's word where it knows all ranks.
    """
    first = values.groupBy(key).agg(F.count(value).alias("count"), sketch(F.col(value)).alias("__sketch"))
    return with_exact_median(first, values, key, value, small_rest).select(key, "median")
