"""Listing of signal files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _listing(spark: SparkSession, path: str, ext: str, recursive: bool) -> DataFrame:
    # only path and length are selected, so no file content is read
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{ext}")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
        .select("path", F.col("length").alias("file_bytes"))
    )


def file_catalog(spark: SparkSession, path: str, layout: str = "recursive", ext: str = ".h5") -> DataFrame:
    """``path, file_bytes`` of the files below ``path``.

    ``flat`` looks into the folder only, ``recursive`` into everything below,
    ``dated`` into the folder and, if it has no such file, into its
    year/month/day folders.
    """
    if layout == "recursive":
        return _listing(spark, path, ext, recursive=True)
    flat = _listing(spark, f"{path}/*{ext}" if _any(spark, f"{path}/*{ext}") else path, ext, recursive=False)
    if layout == "flat":
        return flat
    if layout != "dated":
        raise ValueError(f"unknown layout {layout!r}")
    dated = f"{path}/*/*/*/*{ext}"
    if _any(spark, f"{path}/*{ext}") or not _any(spark, dated):
        return flat
    return _listing(spark, dated, ext, recursive=False)


def _any(spark: SparkSession, glob: str) -> bool:
    """Whether a glob finds a file; asks the file system, starts no job."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(glob)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return found is not None and len(found) > 0
