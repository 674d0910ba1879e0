"""Nested values as rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolode.functions.values import value_kind
from chronolode.session import cut_lineage


def _children(kind: Column, v: Column) -> Column:
    """Whether a value is an array or structure with anything in it."""
    empty = F.to_json(v).isin("[]", "{}")
    return kind.isin("array", "structure") & ~empty


def array_rows(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """Each single value inside the VARIANT ``column`` as a row: ``keep..., path, depth, kind, value``.

    Arrays and structures are walked level by level, to any depth: a level's values are laid out by ``variant_explode`` as
    a lateral join, those that hold others make the next level. ``path`` reads ``$[0].name[2]``; ``depth`` counts its
    steps. Empty arrays and structures are rows of their own, and a value that is no array is one row with path ``$``.
    Missing values (NULL) give no row; a null inside a value does.

    There are as many rounds as levels, each over what the one before has left; a level is written once, so none is
    computed again.
    """
    root = df.where(F.col(column).isNotNull()).select(*keep, F.lit("$").alias("path"), F.lit(0).alias("depth"), F.col(column).alias("value"))
    level = root.withColumn("kind", value_kind(F.col("value")))
    found = level.where(~_children(F.col("kind"), F.col("value")))
    nested = level.where(_children(F.col("kind"), F.col("value")))
    spark = df.sparkSession
    while not nested.isEmpty():
        laid_out = nested.lateralJoin(spark.tvf.variant_explode(F.col("value").outer()).toDF("__pos", "__key", "__child"))
        step = F.when(F.col("__key").isNull(), F.concat(F.lit("["), F.col("__pos").cast("string"), F.lit("]"))).otherwise(
            F.concat(F.lit("."), F.col("__key"))
        )
        level = laid_out.select(*keep, F.concat("path", step).alias("path"), (F.col("depth") + 1).alias("depth"), F.col("__child").alias("value"))
        level = cut_lineage(level.withColumn("kind", value_kind(F.col("value"))))
        found = found.unionByName(level.where(~_children(F.col("kind"), F.col("value"))))
        nested = level.where(_children(F.col("kind"), F.col("value")))
    return found.select(*keep, "path", "depth", "kind", "value")
