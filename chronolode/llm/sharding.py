"""Two-pass external shuffle into shards.

The first pass scatters records by a seeded hash into buckets that fit in memory; the second shuffles each bucket
(Fisher-Yates) and numbers its records. Buckets in order form one random permutation of all records, cut into shards
whose counts differ by one at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronolode.llm.common import fresh, text_of

BUCKET_BYTES = 32 << 20
SEED = 20_231


def record_size(text: Column | str = "text") -> Column:
    """UTF-8 bytes of the text (null: none) plus 16."""
    return F.octet_length(text_of(text)).cast("long") + 16


def _hashable(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    kind = field.dataType.simpleString()
    return F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else column


def _fisher_yates(n: int, seed: int) -> np.ndarray:
    """A uniform permutation of n records: from the end, each place changes with one at or before it."""
    places = np.arange(n)
    np.random.Generator(np.random.PCG64(seed)).shuffle(places)
    return places


def external_shuffle(docs: DataFrame, shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` (doc_id, text) with shard and slot.

    Shard counts differ by one at most; slots run from 0 without gaps in a shard. The result depends on rows and seed
    alone, not on their order or partitions: a bucket is sorted by key, text hash and whole-row hash before it is
    shuffled, and rows equal in all three are interchangeable. Null texts count as empty and null ids are hashed like
    values. Input columns named shard or slot are replaced. An empty table gives no rows.
    """
    docs = docs.drop("shard", "slot")
    bucket, first, total, mix, at = (fresh(docs, n) for n in ("bucket", "bucket_start", "total_rows", "row_hash", "place"))
    whole = [_hashable(f) for f in docs.schema]
    size = docs.agg(F.sum(record_size())).first()[0] or 0
    buckets = int(max(shards, -(-size // bucket_bytes)))
    keyed = docs.withColumn(mix, F.xxhash64(F.lit(seed), *whole)).withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(mix)), F.lit(buckets)).cast("int"))
    counts = keyed.groupBy(bucket).agg(F.count("*").alias(total))
    order = Window.orderBy(bucket)
    starts = counts.select(
        bucket,
        (F.sum(total).over(order) - F.col(total)).alias(first),
        F.sum(total).over(Window.partitionBy()).alias(total),
    )
    rows = keyed.join(starts, bucket)
    schema = T.StructType([*rows.schema.fields, T.StructField(at, T.LongType())])

    def shuffle(part: pa.Table) -> pa.Table:
        part = part.take(np.argsort(part.column(mix).to_numpy(), kind="stable"))
        number, begin = part.column(bucket)[0].as_py(), part.column(first)[0].as_py()
        part = part.take(_fisher_yates(len(part), seed * 1_000_003 + number))
        return part.append_column(at, pa.array(np.arange(begin, begin + len(part), dtype=np.int64)))

    placed = rows.groupBy(bucket).applyInArrow(shuffle, schema)
    shard = F.expr(f"CAST((`{at}` * {shards} + {shards} - 1) DIV `{total}` AS INT)")
    placed = placed.withColumn("shard", shard)
    begin = F.expr(f"(shard * `{total}`) DIV {shards}")
    return placed.withColumn("slot", F.col(at) - begin).drop(bucket, first, total, mix, at)


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder per shard, its rows in slot order. A repeated write replaces the whole result."""
    shuffled.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
