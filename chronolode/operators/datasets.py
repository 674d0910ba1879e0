"""Datasets: blocks of (begin, end, signals) and the data they denote."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolode.functions.timestamps import div
from chronolode.functions.values import text_match
from chronolode.operators.ranks import small_side
from chronolode.schema import NS_PER_DAY
from chronolode.session import cut_lineage

# An interval is covered by aligned cells of 1, 8, 64, ... days, of each size fewer than 16.
CELL_FACTOR = 8
CELL_SIZES = 7


def dataset_extent(datasets: DataFrame) -> DataFrame:
    """``dataset_id, begin_ns, end_ns`` over all blocks; NULL without blocks."""
    return datasets.select(
        "dataset_id",
        F.array_min(F.transform("blocks", lambda b: b["begin_ns"])).alias("begin_ns"),
        F.array_max(F.transform("blocks", lambda b: b["end_ns"])).alias("end_ns"),
    )


def dataset_pvs(datasets: DataFrame) -> DataFrame:
    """``dataset_id, pvs`` in block order, repeats kept."""
    return datasets.select("dataset_id", F.flatten(F.transform("blocks", lambda b: b["pvs"])).alias("pvs"))


def datasets_query(
    datasets: DataFrame, id=None, owner: str | None = None, text: str | None = None, pv: str | None = None
) -> DataFrame:
    """Criteria: id AND owner AND (text OR signal name); none given means all."""
    out = datasets
    if id is not None:
        out = out.where(F.col("dataset_id") == id)
    if owner is not None:
        out = out.where(F.col("owner") == owner)
    either = []
    if text is not None:
        either.append(text_match(text, F.col("name"), F.col("description")))
    if pv is not None:
        either.append(F.exists("blocks", lambda b: F.array_contains(b["pvs"], pv)))
    if either:
        test = either[0]
        for more in either[1:]:
            test = test | more
        out = out.where(test)
    return out


def block_intervals(datasets: DataFrame) -> DataFrame:
    """``dataset_id, pv, begin_ns, end_ns, prev_end_ns``: disjoint intervals per dataset and signal.

    Overlapping or touching blocks become one interval, so a sample matches a
    dataset at most once and results need no de-duplication afterwards.
    """
    rows = (
        datasets.select("dataset_id", F.explode("blocks").alias("b"))
        .select("dataset_id", F.col("b.begin_ns").alias("begin_ns"), F.col("b.end_ns").alias("end_ns"),
                F.explode("b.pvs").alias("pv"))
        .where(F.col("begin_ns") < F.col("end_ns"))
        .distinct()
    )
    order = Window.partitionBy("dataset_id", "pv").orderBy("begin_ns", "end_ns")
    reach = F.max("end_ns").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("begin_ns") > reach, F.lit(True)).cast("int")
    islands = rows.withColumn("__new", opens).withColumn(
        "__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    merged = islands.groupBy("dataset_id", "pv", "__island").agg(
        F.min("begin_ns").alias("begin_ns"), F.max("end_ns").alias("end_ns")
    )
    previous = F.lag("end_ns").over(Window.partitionBy("dataset_id", "pv").orderBy("__island"))
    return merged.withColumn("prev_end_ns", previous).drop("__island")


def _down(a: Column, b: int) -> Column:
    """Whole steps of ``b`` in ``a``, downwards before the epoch too."""
    return div(a - F.pmod(a, F.lit(b).cast("bigint")), b)


def cover(begin_ns: Column, end_ns: Column) -> Column:
    """``array<struct<size, cell>>``: few aligned cells of different sizes that cover the days of [begin, end).

    Of each size those cells are taken that no larger aligned cell within the days holds, so their number grows with
    the logarithm of the interval, and no day is covered twice.
    """
    low, high = _down(begin_ns, NS_PER_DAY), _down(end_ns - 1, NS_PER_DAY) + 1

    def of_size(k: int) -> Column:
        days = CELL_FACTOR**k
        first, after = _down(low + (days - 1), days), _down(high, days)  # cells within, first and behind the last
        up, down = _down(first + (CELL_FACTOR - 1), CELL_FACTOR) * CELL_FACTOR, _down(after, CELL_FACTOR) * CELL_FACTOR
        split = (up <= down) & (k < CELL_SIZES - 1)

        def cells(a: Column, b: Column) -> Column:
            return F.when(a < b, F.transform(F.sequence(a, b - 1), lambda c: F.struct(F.lit(k).alias("size"), c.alias("cell"))))

        none = F.array().cast("array<struct<size:int,cell:bigint>>")
        return F.when(split, F.concat(F.coalesce(cells(first, up), none), F.coalesce(cells(down, after), none))).otherwise(F.coalesce(cells(first, after), none))

    return F.concat(*(of_size(k) for k in range(CELL_SIZES)))


def _spots(instant: str, sizes: list[int], shift: int = 0) -> list[Column]:
    """The cell of each size that an instant is in; ``shift`` sets sizes of another kind apart."""
    return [F.struct(F.lit(k + shift).alias("size"), _down(_down(F.col(instant), NS_PER_DAY), CELL_FACTOR**k).alias("cell")) for k in sizes]


def _in_cells(rows: DataFrame, cells: Column) -> DataFrame:
    """``rows`` once per cell (``__size``, ``__cell``)."""
    spread = rows.withColumn("__c", F.explode(cells))
    return spread.withColumns({"__size": F.col("__c.size"), "__cell": F.col("__c.cell")}).drop("__c")


def _sizes(cells: DataFrame) -> tuple[list[int], int]:
    """Sizes in use and number of rows; at most a row for each of ``CELL_SIZES`` sizes is read."""
    counts = cells.groupBy("__size").count().collect()
    return sorted(r["__size"] for r in counts) or [0], sum(r["count"] for r in counts)


def dataset_resolve(datasets: DataFrame, samples: DataFrame) -> DataFrame:
    """``dataset_id, pv, ts_ns, value`` of the samples in each dataset's blocks.

    One join for intervals of any length: an interval is there once per cell of its cover, a sample once per size of cell
    in use, and they meet on (signal, size, cell), so a hot signal is spread over its days. Intervals are written and
    counted first, so that they are broadcast only by their count and size.
    """
    columns = ["dataset_id", "pv", "ts_ns", "value"]
    intervals = block_intervals(datasets).drop("prev_end_ns")
    cells = cut_lineage(_in_cells(intervals, cover(F.col("begin_ns"), F.col("end_ns"))))
    sizes, n = _sizes(cells)
    inside = (F.col("ts_ns") >= F.col("begin_ns")) & (F.col("ts_ns") < F.col("end_ns"))
    placed = _in_cells(samples.select(*columns[1:]), F.array(*_spots("ts_ns", sizes)))
    return placed.join(small_side(cells, n), ["pv", "__size", "__cell"]).where(inside).select(*columns)


def dataset_buckets(datasets: DataFrame, buckets: DataFrame) -> DataFrame:
    """``dataset_id`` and the buckets that overlap its blocks, each once per dataset.

    A bucket and an interval overlap if the bucket begins in the interval, or the interval begins within the bucket after
    its first instant; never both. In the first case the bucket's first instant meets the cells of the interval, in the
    second the interval's begin those of the bucket, both on (signal, size, cell) in one join. Of several intervals of a
    dataset in one bucket the first is kept: the one whose predecessor ends before the bucket begins.
    """
    turned = 100  # sizes of cells of buckets
    intervals = block_intervals(datasets)
    begun = _in_cells(intervals, cover(F.col("begin_ns"), F.col("end_ns")))
    within = _in_cells(intervals, F.array(*_spots("begin_ns", list(range(CELL_SIZES)), turned)))
    cells = cut_lineage(begun.unionByName(within))
    sizes, n = _sizes(cells)
    own = F.transform(cover(F.col("first_ns"), F.col("last_ns") + 1), lambda c: F.struct((c["size"] + turned).alias("size"), c["cell"].alias("cell")))
    none = F.array().cast("array<struct<size:int,cell:bigint>>")
    spots = F.array(*_spots("first_ns", [k for k in sizes if k < turned]))
    spread = _in_cells(buckets, F.concat(spots, F.when(F.col("last_ns") > F.col("first_ns"), own).otherwise(none)))
    first, begin = F.col("first_ns"), F.col("begin_ns")
    bucket_begins = (first >= begin) & (first < F.col("end_ns"))
    interval_begins = (begin > first) & (begin <= F.col("last_ns")) & F.coalesce(F.col("prev_end_ns") <= first, F.lit(True))
    found = spread.join(small_side(cells, n), ["pv", "__size", "__cell"])
    found = found.where(F.when(F.col("__size") < turned, bucket_begins).otherwise(interval_begins))
    return found.select("dataset_id", *buckets.columns)


def exists_by_id(table: DataFrame, ids: DataFrame, id: str) -> DataFrame:
    """``id, found`` for a table of ids; duplicates in ``ids`` are answered once."""
    known = table.select(id).distinct().withColumn("found", F.lit(True))
    return ids.select(id).distinct().join(known, id, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def create_datasets(incoming: DataFrame) -> DataFrame:
    """Add ``dataset_id``, ``status`` and ``message``: names, owner and whole blocks are required."""
    blocks_ok = F.forall(
        "blocks",
        lambda b: b["begin_ns"].isNotNull() & b["end_ns"].isNotNull() & (b["begin_ns"] <= b["end_ns"]) & (F.size(b["pvs"]) > 0),
    )

    def blank(c):
        return F.col(c).isNull() | (F.col(c) == "")

    fault = (
        F.when(blank("name"), "name missing")
        .when(blank("owner"), "owner missing")
        .when(F.coalesce(F.size("blocks"), F.lit(0)) < 1, "no data blocks")
        .when(~F.coalesce(blocks_ok, F.lit(False)), "incomplete data block")
    )
    made = F.sha2(F.concat_ws("\x1f", "owner", "name", "description", F.to_json("blocks")), 256)
    return (
        incoming.withColumn("message", F.coalesce(fault, F.lit("")))
        .withColumn("status", F.when(F.col("message") == "", "CREATED").otherwise("REJECT"))
        .withColumn("dataset_id", F.when(F.col("status") == "CREATED", made))
    )
