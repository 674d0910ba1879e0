"""Exports of datasets: tabular CSV and bucketed Parquet."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronolode.operators.datasets import dataset_buckets, dataset_resolve
from chronolode.operators.tables import column_groups, table_columns
from chronolode.session import cut_lineage

# Signals of one CSV table; a wider dataset is written as several tables.
TABLE_COLUMNS = 1_000


def _one(datasets: DataFrame, id) -> DataFrame:
    return datasets.where(F.col("dataset_id") == id)


def export_csv(datasets: DataFrame, samples: DataFrame, id, path: str, columns: int = TABLE_COLUMNS) -> str:
    """One row per instant and one column per signal of the dataset, in time order; returns the path.

    A dataset of more than ``columns`` signals is written as several tables
    ``path/columns-00000``, ``path/columns-00001`` and so on. All have the
    same key ``ts_ns``, and one row for each instant of their own signals.
    """
    dataset = _one(datasets, id)
    pvs = dataset.select(F.explode("blocks").alias("b")).select(F.explode("b.pvs").alias("pv")).distinct()
    # a CSV header is a list of names
    groups = column_groups(sorted(r.pv for r in pvs.collect()), columns)
    resolved = dataset_resolve(dataset, samples)
    if len(groups) > 1:
        resolved = cut_lineage(resolved)
    for k, names in enumerate(groups or [[]]):
        target = path if len(groups) < 2 else f"{path}/columns-{k:05d}"
        table_columns(resolved, None, None, names).orderBy("ts_ns").write.mode("overwrite").option("header", True).csv(target)
    return path


def export_bucketed(datasets: DataFrame, buckets: DataFrame, id, path: str) -> str:
    """The dataset's buckets as columnar files; returns the path."""
    found = dataset_buckets(_one(datasets, id), buckets)
    found.repartitionByRange("pv", "first_ns").sortWithinPartitions("pv", "first_ns").write.mode(
        "overwrite"
    ).parquet(path)
    return path


def export_data(datasets: DataFrame, samples: DataFrame, buckets: DataFrame, id, fmt: str | None, path: str) -> tuple[str, str]:
    """``(path, "")``, or ``("", reason)`` when the format or the dataset is not known."""
    if fmt not in ("csv", "bucketed"):
        return "", f"REJECTED: export format {fmt!r} is not available"
    if _one(datasets, id).isEmpty():
        return "", f"REJECTED: no dataset {id!r}"
    return (export_csv(datasets, samples, id, path) if fmt == "csv" else export_bucketed(datasets, buckets, id, path)), ""
