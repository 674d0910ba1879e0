"""Tabular query results: one row per instant."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolode.operators.buckets import select_pvs

def in_range(samples: DataFrame, begin_ns: int | None, end_ns: int | None) -> DataFrame:
    if begin_ns is not None:
        samples = samples.where(F.col("ts_ns") >= begin_ns)
    if end_ns is not None:
        samples = samples.where(F.col("ts_ns") < end_ns)
    return samples


def _one_value(samples: DataFrame) -> Column:
    """The value of a signal at an instant: the latest bucket's, else the largest; NaN only where there is no other."""
    number = ~F.isnan("value")
    if "bucket_id" in samples.columns:
        return F.max_by("value", F.struct(number, F.col("bucket_id"), F.col("value")))
    return F.max_by("value", F.struct(number, F.col("value")))


def table_columns(samples: DataFrame, begin_ns: int | None, end_ns: int | None, pvs: list[str]) -> DataFrame:
    """``ts_ns`` and one column per named signal, NULL where it has no sample.

    A column for each of very many signals makes a wide plan; ``table_rows``
    and ``column_groups`` have none.
    """
    found = in_range(select_pvs(samples, pvs), begin_ns, end_ns)
    return found.groupBy("ts_ns").pivot("pv", pvs).agg(_one_value(found))


def table_rows(
    samples: DataFrame,
    begin_ns: int | None,
    end_ns: int | None,
    pvs: list[str] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """``ts_ns, values``: a map from signal to value per instant.

    Equal (instant, signal) pairs are reduced first, so a map holds each
    signal of that instant once.
    """
    found = in_range(select_pvs(samples, pvs, pattern), begin_ns, end_ns)
    single = found.groupBy("ts_ns", "pv").agg(_one_value(found).alias("value"))
    entries = F.array_sort(F.collect_list(F.struct("pv", "value")))
    return single.groupBy("ts_ns").agg(F.map_from_entries(entries).alias("values"))


def table_pattern(
    samples: DataFrame, begin_ns: int | None, end_ns: int | None, pattern: str, fmt: str = "rows"
) -> DataFrame:
    """The table of all signals a regular expression finds, in either form."""
    if fmt == "rows":
        return table_rows(samples, begin_ns, end_ns, pattern=pattern)
    names = in_range(select_pvs(samples, pattern=pattern), begin_ns, end_ns).select("pv").distinct()
    # the columns of a table must be known to plan it
    listed = sorted(r.pv for r in names.collect())
    return table_columns(samples, begin_ns, end_ns, listed)


def table_to_map(table: DataFrame) -> DataFrame:
    """Either table form back to ``pv, ts_ns, value``; instants without a value are left out."""
    if table.columns == ["ts_ns", "values"]:
        return table.select("ts_ns", F.explode("values").alias("pv", "value")).select("pv", "ts_ns", "value")
    # quoted, as names of signals may hold dots and backticks
    pvs = [c for c in table.columns if c != "ts_ns"]
    cells = [F.struct(F.lit(c).alias("pv"), F.col(f"`{c.replace('`', '``')}`").alias("value")) for c in pvs]
    rows = table.select("ts_ns", F.explode(F.array(*cells)).alias("c"))
    return rows.select("c.pv", "ts_ns", "c.value").where(F.col("value").isNotNull())


def column_groups(pvs: list[str], size: int) -> list[list[str]]:
    """Names in groups, for tables too wide for one plan; each group makes a table over the same instants."""
    return [pvs[i : i + size] for i in range(0, len(pvs), size)]
