"""Explicit schemas of the canonical tables and the nanosecond constants.

Instants are BIGINT nanoseconds since the epoch: Spark timestamps stop at
microseconds, and the data model counts in nanoseconds.
"""

from pyspark.sql import types as T

NS_PER_SEC = 1_000_000_000
NS_PER_DAY = 86_400 * NS_PER_SEC

CLOCK = "CLOCK"
LIST = "LIST"

TIMESTAMPS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start_ns", T.LongType()),
        T.StructField("period_ns", T.LongType()),
        T.StructField("count", T.LongType()),
        T.StructField("ts_ns", T.ArrayType(T.LongType())),
    ]
)

COLUMN = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("vals", T.ArrayType(T.DoubleType())),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("description", T.StringType()),
        T.StructField("start_ns", T.LongType()),
        T.StructField("stop_ns", T.LongType()),
    ]
)

TAGS = T.ArrayType(T.StringType())
ATTRIBUTES = T.MapType(T.StringType(), T.StringType())

RAW_SIGNALS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file_bytes", T.LongType()),
        T.StructField("n_objects", T.IntegerType()),
        T.StructField("signal_name", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("matlab_class", T.StringType()),
        T.StructField("dims", T.ArrayType(T.LongType())),
        T.StructField("secs", T.ArrayType(T.LongType())),
        T.StructField("nanos", T.ArrayType(T.LongType())),
        T.StructField("vals", T.ArrayType(T.DoubleType())),
    ]
)

# Conditions of a bucket's samples as runs of equal ones; NULL where every sample is normal.
STATUS_RUNS = T.ArrayType(
    T.StructType(
        [
            T.StructField("n", T.IntegerType()),
            T.StructField("severity", T.IntegerType()),
            T.StructField("status", T.IntegerType()),
            T.StructField("message", T.StringType()),
        ]
    )
)

# Values that are no DOUBLE, by the storage of their type; all NULL in a DOUBLE bucket.
TYPED_VALUES = [
    T.StructField("longs", T.ArrayType(T.LongType())),
    T.StructField("flags", T.ArrayType(T.BooleanType())),
    T.StructField("codes", T.ArrayType(T.IntegerType())),
    T.StructField("labels", T.ArrayType(T.StringType())),
    T.StructField("blobs", T.ArrayType(T.BinaryType())),
    T.StructField("nested", T.ArrayType(T.StringType())),
]

INGEST_REQUESTS = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("provider_id", T.StringType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("tags", TAGS),
        T.StructField("attributes", ATTRIBUTES),
        T.StructField("event", EVENT),
        T.StructField("ts", TIMESTAMPS),
        T.StructField("columns", T.ArrayType(COLUMN)),
        T.StructField("received_ns", T.LongType()),
    ]
)

BUCKETS = T.StructType(
    [
        T.StructField("bucket_id", T.StringType()),
        T.StructField("pv", T.StringType()),
        T.StructField("provider_id", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("first_ns", T.LongType()),
        T.StructField("last_ns", T.LongType()),
        T.StructField("sample_count", T.LongType()),
        T.StructField("period_ns", T.LongType()),
        T.StructField("ts_kind", T.StringType()),
        T.StructField("ts_ns", T.ArrayType(T.LongType())),
        T.StructField("data_type", T.StringType()),
        T.StructField("vals", T.ArrayType(T.DoubleType())),
        *TYPED_VALUES,
        T.StructField("status_runs", STATUS_RUNS),
        T.StructField("tags", TAGS),
        T.StructField("attributes", ATTRIBUTES),
        T.StructField("event", EVENT),
        T.StructField("created_ns", T.LongType()),
        T.StructField("day", T.DateType()),
    ]
)

REQUEST_STATUS = T.StructType(
    [
        T.StructField("status_id", T.StringType()),
        T.StructField("provider_id", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("bucket_ids", T.ArrayType(T.StringType())),
        T.StructField("update_ns", T.LongType()),
    ]
)

PROVIDERS = T.StructType(
    [
        T.StructField("provider_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("tags", TAGS),
        T.StructField("attributes", ATTRIBUTES),
    ]
)

DATA_BLOCK = T.StructType(
    [
        T.StructField("begin_ns", T.LongType()),
        T.StructField("end_ns", T.LongType()),
        T.StructField("pvs", T.ArrayType(T.StringType())),
    ]
)

DATASETS = T.StructType(
    [
        T.StructField("dataset_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("blocks", T.ArrayType(DATA_BLOCK)),
    ]
)

CALCULATION_FRAME = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("ts", TIMESTAMPS),
        T.StructField("columns", T.ArrayType(COLUMN)),
    ]
)

ARCHIVE_POINT = T.StructType(
    [
        T.StructField("secs", T.LongType()),
        T.StructField("nanos", T.LongType()),
        T.StructField("val", T.StringType()),
        T.StructField("severity", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("fields", ATTRIBUTES),
    ]
)
