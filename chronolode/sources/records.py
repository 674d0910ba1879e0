"""Tables of records (datasets, annotations, providers), kept by key in hash folders.

An upsert reads and rewrites only the folders its keys fall into, so a small change of a large table stays small. Records
of other folders are never read. A table is written by one upsert at a time.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolode.operators.annotations import calculation_frames, create_annotations
from chronolode.operators.datasets import create_datasets
from chronolode.session import cut_lineage

FOLDERS = 64


def read_records(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored records, or None where there are none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # no such path, or nothing in it
        return None


def upsert_records(rows: DataFrame, path: str, key: str, folders: int = FOLDERS) -> None:
    """Add ``rows`` to the table; a record of the same key is replaced, and of equal keys in ``rows`` one stays.

    Rows without a key are left out. A table keeps the number of folders it began with.
    """
    spark = rows.sparkSession
    stored = read_records(spark, path)
    folder = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(folders)).cast("int")
    new = cut_lineage(rows.where(F.col(key).isNotNull()).dropDuplicates([key]).withColumn("folder", folder))
    touched = [r[0] for r in new.select("folder").distinct().collect()]  # at most ``folders``
    if not touched:
        return
    if stored is not None:
        old = stored.where(F.col("folder").isin(touched)).join(new.select(key), key, "left_anti")
        # written first: the folders are replaced by what is read from them
        new = cut_lineage(new.unionByName(old, allowMissingColumns=True))
    writer = new.repartition("folder").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("folder").parquet(path)


def store_datasets(incoming: DataFrame, path: str) -> DataFrame:
    """Create datasets and store those that are complete; returns all of them with id, status and message.

    The id is a hash of the content, so creating a dataset again changes nothing.
    """
    made = cut_lineage(create_datasets(incoming))
    upsert_records(made.where("status = 'CREATED'").drop("status", "message"), path, "dataset_id")
    return made


def store_annotations(incoming: DataFrame, path: str, datasets_path: str) -> DataFrame:
    """Create annotations, with their calculations, and store those whose references are stored; returns all of them.

    References are looked up in the stored tables of datasets and annotations.
    """
    spark = incoming.sparkSession
    datasets, annotations = read_records(spark, datasets_path), read_records(spark, path)
    none = spark.createDataFrame([], "dataset_id string, annotation_id string")
    made = create_annotations(incoming, none if datasets is None else datasets, none if annotations is None else annotations)
    made = cut_lineage(made)
    upsert_records(made.where("status = 'CREATED'").drop("status", "message"), path, "annotation_id")
    return made


def stored_calculations(annotations: DataFrame) -> DataFrame:
    """Samples of the calculations that annotations hold (``calculations``: array of frames), by ``annotation_id``."""
    frames = annotations.where(F.size("calculations") > 0).select(F.col("annotation_id").alias("calc_id"), F.col("calculations").alias("frames"))
    return calculation_frames(frames).withColumnRenamed("calc_id", "annotation_id")
