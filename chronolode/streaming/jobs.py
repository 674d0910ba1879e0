"""Live ingest and live subscription on a file source; any Spark source fits.

Progress lives in the checkpoint: starting again with the same checkpoint
continues after the last finished batch.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, MapType, StructField, StructType

from chronolode import schema
from chronolode.operators.axis import expand_timestamps
from chronolode.operators.buckets import request_buckets
from chronolode.operators.ingest import accepted, request_status, status_id, validate_requests
from chronolode.operators.ranks import small_side
from chronolode.session import cut_lineage
from chronolode.sources.store import insert_buckets


def request_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None, shape: StructType = schema.INGEST_REQUESTS
) -> DataFrame:
    """Ingest requests as they arrive as Parquet files."""
    reader = spark.readStream.schema(shape)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark keeps in a checkpoint, the same whenever its query starts again."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def _delivery(request: DataFrame) -> Column:
    """A number that tells requests of one id with different contents apart, whenever received; maps are hashed by their entries."""
    fields = [f for f in request.schema if f.name != "received_ns"]
    plain = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, MapType) else F.col(f.name) for f in fields]
    return F.xxhash64(*plain)


#: A request that arrives with the same provider, id and contents is the same one.
SAME = ["provider_id", "request_id", "delivery"]
KNOWN = "provider_id IS NOT NULL AND coalesce(request_id, '') <> ''"


def _single(batch: DataFrame) -> DataFrame:
    """``batch`` with ``delivery``, each request once.

    ``delivery`` covers provider and id, so it alone is counted; what it finds is compared by all of ``SAME``, and only
    that travels.
    """
    marked = batch.withColumn("delivery", _delivery(batch))
    repeated = marked.where(KNOWN).groupBy("delivery").agg(F.count("*").alias("n")).where("n > 1").select("delivery")
    repeated = cut_lineage(repeated)
    n = repeated.count()
    if not n:
        return marked
    repeated = small_side(repeated, n)
    others = marked.join(repeated, "delivery", "left_anti").select(*marked.columns)
    turn = F.row_number().over(Window.partitionBy(*SAME).orderBy("received_ns"))
    found = marked.join(repeated, "delivery", "left_semi").withColumn("__turn", turn).where(f"__turn = 1 OR NOT ({KNOWN})")
    return others.unionByName(found.select(*marked.columns))


def _replace_batch(df: DataFrame, folder: str) -> None:
    """Write under the folder of one batch of one query; a repeated batch replaces itself."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(folder)


def stream_ingest(
    source: DataFrame, providers: DataFrame, out: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Validate requests as they come, store their buckets and one status row each.

    Every batch owns a folder under the id its checkpoint gives the query. So
    a batch run again after a failure leaves no duplicates, and streams with
    other checkpoints can write to the same place. Buckets are written before
    the status rows that report them, from one validation of the batch.

    A task writes one file, sorted by day and signal, so a batch makes no more files than it has tasks, whatever number
    of days it touches; ``merge_stream`` brings the buckets into day folders. Status rows are stored without their id,
    which :func:`ingested_status` makes from provider and request.
    """
    known: list[str] = []

    def ingest(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(_query_id(batch.sparkSession, checkpoint))
        own = f"source={known[0]}/batch={batch_id}"
        checked = validate_requests(_single(batch), providers).persist()
        try:
            buckets = request_buckets(accepted(checked), "delivery").sortWithinPartitions("day", "pv", "first_ns")
            _replace_batch(buckets, f"{out}/buckets/{own}")
            _replace_batch(request_status(checked, "delivery").drop("status_id"), f"{out}/status/{own}")
        finally:
            checked.unpersist()

    writer = source.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _once(rows: DataFrame) -> DataFrame:
    """Of requests that several batches or streams have stored, the rows of the first one.

    Two numbers a row are shuffled to find them, one for the request and one for its place; only requests with several
    places are then compared by all of ``SAME``. They are few, and rows travel only if they are not.
    """
    where = ["source", "batch"]
    rows = rows.withColumn("delivery", F.coalesce("delivery", F.lit(0).cast("bigint")))
    keyed = rows.where(KNOWN).select(*SAME, *where, F.xxhash64(*SAME).alias("__key"), F.xxhash64(*where).alias("__place"))
    again = keyed.groupBy("__key").agg(F.min("__place").alias("low"), F.max("__place").alias("high")).where("low <> high")
    again = cut_lineage(again.select("__key"))
    n = again.count()
    if n:
        firsts = keyed.join(small_side(again, n), "__key", "left_semi").groupBy(*SAME).agg(F.min(F.struct(*where)).alias("__first"))
        firsts = cut_lineage(firsts)
        found = rows.join(small_side(firsts, firsts.count()), SAME, "left")
        rows = found.where(F.col("__first").isNull() | (F.struct(*where) == F.col("__first"))).select(*rows.columns)
    return rows.drop("delivery", *where)


def _stored(spark: SparkSession, folder: str, shape: StructType) -> DataFrame:
    return _once(spark.read.schema(StructType([*shape, StructField("delivery", LongType())])).parquet(folder))


def ingested_buckets(spark: SparkSession, out: str) -> DataFrame:
    """Buckets that streams have stored so far.

    A stream that lost its checkpoint reads its input again into folders of its own, and a request may reach a stream
    twice, in one batch or several; it is taken once. Requests with one id and different contents are all kept.
    """
    return _stored(spark, f"{out}/buckets", schema.BUCKETS).select(*schema.BUCKETS.names)


def ingested_status(spark: SparkSession, out: str) -> DataFrame:
    """Status rows that streams have stored so far, each request once as in :func:`ingested_buckets`."""
    stored = StructType([f for f in schema.REQUEST_STATUS if f.name != "status_id"])
    return _stored(spark, f"{out}/status", stored).select(status_id(), *stored.names)


def ingested(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """Buckets and status rows that streams have stored so far."""
    return ingested_buckets(spark, out), ingested_status(spark, out)


def merge_stream(spark: SparkSession, out: str, store: str) -> None:
    """Add what a stream has stored so far to the store of batch imports; run again, it adds only what is new."""
    insert_buckets(spark.read.schema(schema.BUCKETS).parquet(f"{out}/buckets"), store)


def subscription(source: DataFrame, pvs: list[str], since_ns: int) -> DataFrame:
    """``pv, ts_ns, value, received_ns`` of named signals in requests received after ``since_ns``."""
    new = source.where(F.col("received_ns") > since_ns)
    wanted = new.withColumn("columns", F.filter("columns", lambda c: c["name"].isin(*pvs)))
    buckets = request_buckets(wanted.where(F.size("columns") > 0))
    rows = expand_timestamps(buckets, "pv", "created_ns").drop("pos")
    return rows.withColumnRenamed("created_ns", "received_ns")


def stream_subscribe(
    source: DataFrame,
    pvs: list[str],
    since_ns: int,
    on_data,
    checkpoint: str,
    on_error=None,
    available_now: bool = False,
) -> StreamingQuery:
    """Deliver new samples batch by batch to ``on_data(df, batch_id)``; ``stop()`` cancels."""

    def deliver(batch: DataFrame, batch_id: int) -> None:
        try:
            on_data(batch, batch_id)
        except Exception as error:
            if on_error is None:
                raise
            on_error(error)

    writer = (
        subscription(source, pvs, since_ns)
        .writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
